"""Restartable stages: every stage's table is written with a manifest, and a rerun reads the tables
of the stages that are finished and unchanged (D18).

A manifest (``_work/_manifest/<stage>.json``) holds the stage's key, a digest of its name, its
parameters, the marks of its input files and the keys of the stages it reads. It is written
after the table and everything that belongs to the stage, so a stage that broke off has none.
A stage whose key differs is built again, and with it every stage that reads it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import __version__
from ..sources import files as IO


def input_mark(spark: SparkSession, path: str) -> list:
    """What identifies an input: its path, bytes, number of files and time of change (of a folder:
    of its entries)."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(hp)
    status = fs.getFileStatus(hp)
    changed = [status.getModificationTime(), *(s.getModificationTime() for s in (fs.listStatus(hp) if status.isDirectory() else []))]
    return [path, size.getLength(), size.getFileCount(), max(changed)]


class Stages:
    """The stages of one output folder. ``built`` and ``reused`` list what this run did."""

    def __init__(self, spark: SparkSession, out_dir: str, resume: bool = True):
        self.spark, self.out, self.resume = spark, out_dir.rstrip("/"), resume
        self.built: list[str] = []
        self.reused: list[str] = []
        self._keys: dict[str, str] = {}

    def _manifest(self, name: str) -> str:
        return f"{self.out}/_work/_manifest/{name.replace('/', '.')}.json"

    def _read(self, name: str) -> dict | None:
        path = self._manifest(name)
        if not IO.path_exists(self.spark, path):
            return None
        return json.loads(IO.read_text(self.spark, path))

    def key(self, name: str) -> str:
        """The key of a stage, of this run or of an earlier one."""
        if name not in self._keys:
            found = self._read(name)
            if found is None:
                raise FileNotFoundError(f"Missing file: {self._manifest(name)} (stage {name} has not finished)")
            self._keys[name] = found["key"]
        return self._keys[name]

    def _wanted(self, name: str, params, inputs: Iterable, uses: Sequence[str]) -> str:
        parts = [__version__, name, params, list(inputs), [self.key(u) for u in uses]]
        return hashlib.sha256(json.dumps(parts, default=str, sort_keys=True).encode()).hexdigest()

    def finished(self, name: str, params=None, inputs: Iterable = (), uses: Sequence[str] = ()) -> bool:
        """Whether an earlier run finished the stage as it would be built now."""
        found = self._read(name) if self.resume else None
        return found is not None and found["key"] == self._wanted(name, params, inputs, uses)

    def table(self, name: str, build: Callable[[], DataFrame], params=None, inputs: Iterable = (), uses: Sequence[str] = (),
              path: str | None = None, partition_by: Sequence[str] | None = None,
              after: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """The stage's table: read back if finished, else built, written below ``path`` (default
        ``_work/<name>``) and marked. ``after`` writes what else belongs to the stage."""
        inputs = list(inputs)
        where = path or f"{self.out}/_work/{name}"
        if self.finished(name, params, inputs, uses):
            self._keys[name] = self.key(name)
            self.reused.append(name)
            schema = T.StructType.fromJson(self._read(name)["schema"])
            parts = list(partition_by or [])
            stored = T.StructType([f for f in schema if f.name not in parts] + [schema[p] for p in parts])
            return self.spark.read.schema(stored).parquet(where).select(*[f"`{f.name}`" for f in schema])
        IO.delete(self.spark, self._manifest(name))
        out = IO.checkpoint_table(build(), where, partition_by)
        if after is not None:
            after(out)
        self._keys[name] = self._wanted(name, params, inputs, uses)
        self.built.append(name)
        manifest = {"stage": name, "key": self._keys[name], "params": params, "inputs": inputs, "uses": list(uses),
                    "path": where, "schema": json.loads(out.schema.json())}
        IO.write_text(self.spark, self._manifest(name), json.dumps(manifest, default=str, indent=1))
        return out

    def action(self, name: str, act: Callable[[], None], params=None, uses: Sequence[str] = ()) -> None:
        """A stage that only writes reports: done once for each key."""
        if self.finished(name, params, (), uses):
            self.reused.append(name)
            return
        IO.delete(self.spark, self._manifest(name))
        act()
        self.built.append(name)
        self._keys[name] = self._wanted(name, params, (), uses)
        IO.write_text(self.spark, self._manifest(name), json.dumps({"stage": name, "key": self._keys[name], "params": params,
                                                                   "uses": list(uses)}, default=str, indent=1))
