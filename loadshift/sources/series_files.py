"""The files of a series as a table: listing, types from footers, reads in groups, and a writer.

* :func:`open_files` lists the source's files of the requested arms in tasks, reads their footers
  once (types and rows), and keeps the files of an id table by a join.
* Small files of plain types (most, where a building has few readings) are read by tasks that
  take ``TASK_FILES`` of them each: their paths stay in a table, in no plan and not on the driver.
* The others are read by Spark's reader in groups of at most about ``GROUP_FILES`` files: no list
  of ids enters a plan, and a caller that handles one group after the other holds the paths of one.
* Files of one folder may give a column different types (S6): each column gets the widest type that
  all its files can be bound to. Files that Spark's reader cannot widen by itself
  form groups of their own, read with their own types and cast.
* :class:`SeriesFileSource` writes the source layout: tasks name the files
  ``<bldg_id>-<upgrade>.parquet`` themselves and move them into place when they are whole.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pfs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from ..functions import columns as C
from ..session import scratch_path

# tasks need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_ID_PATTERN = r"^(\d+)-(\d+)\.parquet$"
# Files opened by one scan; their paths are on the driver while it is planned.
GROUP_FILES = 20_000
# Rows of a row group of written files.
ROW_GROUP = 1 << 17
# A file of at most so many bytes and rows is small: a task holds the whole of it.
SMALL_BYTES, SMALL_ROWS = 1 << 20, ROW_GROUP
# Small files of a task; a few more tasks than cores are made from LEAST_FILES on.
TASK_FILES, LEAST_FILES = 1000, 50
# Rows that small files are joined to before they leave Python.
BATCH_ROWS = 10_000


# ---- listing -------------------------------------------------------------------

LISTED = "folder string, path string, size long"


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark names it, with its scheme."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hp).toString()


def _hidden(part: str) -> bool:
    return part.startswith(".") or (part.startswith("_") and "=" not in part)


def _list_by_store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files below every folder; a null path where the store is not one that is listed here."""
    def rows(folder: str, found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([folder] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string()),
                                           pa.array([f[1] for f in found], pa.int64())], ["folder", "path", "size"])

    for b in batches:
        for folder in b.column("folder").to_pylist():
            try:
                store, at = _store(folder)
                infos = store.get_file_info(pfs.FileSelector(at, recursive=True))
            except Exception:  # noqa: BLE001  another store: the caller lists it with Spark
                yield rows(folder, [(None, None)])
                continue
            found = []
            for i in infos:
                below = i.path[len(at.rstrip("/")):]
                if i.type == pfs.FileType.File and not any(map(_hidden, below.strip("/").split("/"))):
                    found.append((folder.rstrip("/") + below, i.size))
            for k in range(0, len(found), BATCH_ROWS):
                yield rows(folder, found[k:k + BATCH_ROWS])


def _listing(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """(path, size) of all files of the folders, as a written table: a task lists a folder. Folders of a
    store that only Spark lists are listed by it."""
    asked = spark.createDataFrame([(_qualified(spark, f),) for f in folders], "folder string")
    listed = _written(asked.repartition(max(1, len(folders)), "folder").mapInArrow(_list_by_store, LISTED), "series_listing")
    out = listed.where("path IS NOT NULL").select("path", "size")
    far = [r.folder for r in listed.where("path IS NULL").collect()]
    if far:
        out = out.unionByName(spark.read.format("binaryFile").option("basePath", root).load(far)
                              .select("path", F.col("length").alias("size")))
    return out


def _named(listing: DataFrame) -> DataFrame:
    """(path, size, bldg_id, upgrade) of a listing, by file names."""
    name = F.regexp_extract("path", r"/([^/]+)$", 1)
    return listing.select("path", "size", F.regexp_extract(name, FILE_ID_PATTERN, 1).try_cast("int").alias("bldg_id"),
                          F.regexp_extract(name, FILE_ID_PATTERN, 2).try_cast("int").alias("upgrade"))


def list_files(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """(path, size, bldg_id, upgrade) of the files named by building and arm; contents are not read."""
    return _named(_listing(spark, root, folders)).where(F.col("bldg_id").isNotNull())


def _dealt(files: DataFrame, n: int) -> DataFrame:
    """``n`` files dealt to tasks by their paths."""
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, -(-n // TASK_FILES), min(2 * cores, n // LEAST_FILES)), "path")


# ---- types from footers --------------------------------------------------------

# Fixed order of the types that numbers and flags are bound to, narrowest first.
LADDER = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double")
# Types that Spark's parquet reader widens by itself, by the type asked for.
WIDENED = {
    "smallint": {"void", "tinyint", "smallint"},
    "int": {"void", "tinyint", "smallint", "int"},
    "bigint": {"void", "tinyint", "smallint", "int", "bigint"},
    "double": {"void", "tinyint", "smallint", "int", "float", "double"},
}


def common_type(name: str, types: set[str]) -> str:
    """The narrowest type that holds all of ``types``: flags become numbers, whole numbers
    become fractions, and a column that is empty in some files takes the others' type. Text or
    times against anything else cannot be bound, as in the source."""
    types = {"double" if t.startswith("decimal") and len(types) > 1 else t for t in types} - {"void"}
    if len(types) <= 1:
        return next(iter(types), "int")  # empty everywhere: as Spark reads such a column
    if not types <= set(LADDER):
        raise ValueError(f"Column {name} cannot be bound: its files have the types {', '.join(sorted(types))}")
    widest = max(types, key=LADDER.index)
    return "double" if widest == "float" and types & {"int", "bigint"} else widest


# Types of which a task reads a small file as Spark's reader would.
PLAIN = {*LADDER, "string", "void", "timestamp_ntz"}


def _footer(source) -> tuple[int, str, bool]:
    """(rows, columns, plain) of a parquet file. The columns are lines ``position<TAB>name<TAB>type``,
    without those of types that Spark's tables do not have."""
    meta = pq.read_metadata(source)
    schema = meta.schema.to_arrow_schema()
    flat = len(schema) == meta.num_columns
    plain = flat and len({f.name.lower() for f in schema}) == len(schema)
    out = []
    for i, f in enumerate(schema):
        if pa.types.is_null(f.type):
            kind = "void"
        elif flat and meta.schema.column(i).physical_type == "INT96":
            kind = "timestamp"
        else:
            try:
                kind = from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString()
            except Exception:  # noqa: BLE001  a type that Spark's tables do not have
                kind = None
        if kind not in PLAIN or (pa.types.is_timestamp(f.type) and f.type.unit not in ("us", "ms")) or set(f.name) & set("\t\n"):
            plain = False
        if kind is None or set(f.name) & set("\t\n"):
            continue
        out.append(f"{i}\t{f.name}\t{kind}")
    return meta.num_rows, "\n".join(out), plain


FOOTERS = "path string, size long, bldg_id int, upgrade int, n_rows long, columns string, plain boolean, near boolean"


def _footer_rows(b: pa.RecordBatch, found: list[tuple | None], near: bool) -> pa.RecordBatch:
    """The rows of ``b`` with their footers; nulls where there is none. ``near``: read from the store by the task."""
    kept = ["path", "size", "bldg_id", "upgrade"]
    none = (None, None, None)
    new = [pa.array([(f or none)[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.bool_()))]
    flag = pa.array([near and f is not None for f in found], pa.bool_())
    return pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *new, flag], [*kept, "n_rows", "columns", "plain", "near"])


class _Stores:
    """Open files by path; the file system of a folder is looked up once."""

    def __init__(self):
        self.known = {}

    def open(self, path: str) -> pa.NativeFile:
        folder, name = path.rsplit("/", 1)
        if folder not in self.known:
            self.known[folder] = _store(folder)
        store, at = self.known[folder]
        return store.open_input_file(f"{at}/{name}")


def _footers_by_store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The footers of every path, from the file's tail; null where that is not readable."""
    stores = _Stores()
    for b in batches:
        found = []
        for path in b.column("path").to_pylist():
            try:
                with stores.open(path) as f:
                    found.append(_footer(f))
            except Exception:  # noqa: BLE001  another store, or a damaged file: the caller tries Spark's reader
                found.append(None)
        yield _footer_rows(b, found, near=True)


def _footers_by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for footer in b.column("footer").to_pylist():
            try:
                found.append(_footer(pa.BufferReader(footer)))
            except Exception:  # noqa: BLE001  a damaged footer has no types; the file is reported with its status
                found.append(None)
        yield _footer_rows(b, found, near=False)


def _written(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path_groups(files: DataFrame, bound: int = GROUP_FILES) -> Iterator[list[str]]:
    """The paths of a written table, about ``bound`` at a time."""
    n = -(-files.count() // bound)
    for k in range(n):
        paths = files.where(F.pmod(F.xxhash64("path"), F.lit(n)) == k).select("path").collect()
        if paths:
            yield [r.path for r in paths]


def footers(files: DataFrame) -> DataFrame:
    """``files`` (a written table: path, size, bldg_id, upgrade) with the rows and columns of their
    footers, as a written table. Files in a store that only Spark reads are read through it; the
    footer is cut in the JVM. A file without a readable footer has nulls."""
    spark = files.sparkSession
    keys = ["path", "size", "bldg_id", "upgrade"]
    by_store = _written(_dealt(files.select(*keys), files.count()).mapInArrow(_footers_by_store, FOOTERS), "series_footers")
    rest = by_store.where("columns IS NULL").select(*keys)
    found = None
    for paths in _path_groups(rest.select("path")):
        tail = F.hex(F.expr("substring(content, -8, 4)"))  # the footer's length, lowest byte first
        size = F.conv(F.concat(*[F.substring(tail, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")
        content = (spark.read.format("binaryFile").load(paths).where("length >= 12")
                   .select("path", F.least(size + 8, F.col("length")).cast("int").alias("n"), "content")  # any number in a damaged file
                   .select("path", F.expr("substring(content, -n, n)").alias("footer")))
        some = rest.join(content, "path").mapInArrow(_footers_by_content, FOOTERS).where("columns IS NOT NULL")
        found = some if found is None else found.unionByName(some)
    if found is None:
        return by_store
    found = _written(found, "series_footers")
    return by_store.where("columns IS NOT NULL").unionByName(found).unionByName(
        by_store.where("columns IS NULL").join(found.select("path"), "path", "left_anti"))


def _types(footer: DataFrame) -> DataFrame:
    """(path, pos, name, type) of the columns of footers."""
    part = F.split(F.col("line"), "\t")
    return (footer.where("columns <> ''").select("path", F.explode(F.split("columns", "\n")).alias("line"))
            .select("path", part[0].cast("int").alias("pos"), part[1].alias("name"), part[2].alias("type")))


def footer_types(files: DataFrame) -> DataFrame:
    """(path, pos, name, type) of the columns of every file of a written table, from the
    footers. A file without a readable footer has no rows."""
    return _types(footers(files))


def bind_types(types: DataFrame) -> T.StructType | None:
    """The schema of all files of a table of (path, pos, name, type): per column the common
    type. Where no types differ, columns follow the files by path, as Spark merges them, else
    their first position."""
    found: dict[str, set[str]] = {}
    rows = types.groupBy("name", "type").agg(  # columns x types
        F.min("pos").alias("pos"), F.min(F.struct("path", "pos")).alias("first")).orderBy("pos", "name").collect()
    for r in rows:
        found.setdefault(r.name, set()).add(r.type)
    if not found:
        return None
    if all(len({"int" if t == "void" else t for t in kinds}) == 1 for kinds in found.values()):
        first = {n: min(r.first for r in rows if r.name == n) for n in found}
        found = {n: found[n] for n in sorted(found, key=first.get)}
    return T._parse_datatype_string(", ".join(f"`{n.replace('`', '``')}` {common_type(n, t)}" for n, t in found.items()))


def _schema(spark: SparkSession, root: str, folders: list[str], footer: DataFrame) -> T.StructType:
    """The schema of the files of ``footer``; types that are not plain are merged by Spark where it can."""
    kinds = footer.where("columns IS NOT NULL").groupBy("columns").agg(F.min("path").alias("path"), F.min("plain").alias("plain"))
    kinds = _written(kinds, "series_types")
    if kinds.where("NOT plain").limit(1).count():
        return merged_schema(spark, root, folders) or bind_types(_types(kinds))
    names = [r[0].lower() for r in _types(kinds).select("name").distinct().collect()]
    if len(set(names)) < len(names):  # names that differ by case
        return merged_schema(spark, root, folders) or bind_types(_types(kinds))
    return bind_types(_types(kinds)) or merged_schema(spark, root, folders)


def _own_types(columns: str, target: dict[str, str]) -> list[str]:
    """The columns that Spark's reader does not widen to ``target`` by itself, as lines ``name<TAB>type``."""
    found = [line.split("\t")[1:] for line in columns.split("\n")] if columns else []
    return sorted(f"{n}\t{t}" for n, t in found if n in target and t not in WIDENED.get(target[n], {target[n], "void"}))


def _routed(footer: DataFrame, schema: T.StructType, given: bool, parted: set[str]) -> DataFrame:
    """(path, bldg_id, upgrade, n_rows, kind, small) of the files: whether a task reads the file whole, else by
    which own types Spark's reader does. With a ``given`` schema, types that it does not widen are left to
    Spark's reader."""
    target = {f.name: f.dataType.simpleString() for f in schema if f.name != "bldg_id"}
    lower = {n.lower(): n for n in target}
    able = set(target.values()) <= PLAIN and len(lower) == len(target) and not {p.lower() for p in parted} & {*lower, "bldg_id"}

    def route(columns: str) -> tuple[str, bool]:
        own = _own_types(columns, target)
        names = [line.split("\t")[1] for line in columns.split("\n")] if columns else []
        same = all(lower.get(n.lower(), n) == n for n in names) and not {n.lower() for n in names} & {p.lower() for p in parted}
        return "" if given else "\n".join(own), able and same and not (given and own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {None: ("", False)}
        for b in batches:
            sizes, rows, columns, plain, near = (b.column(c).to_pylist() for c in ("size", "n_rows", "columns", "plain", "near"))
            for c in set(columns) - known.keys():
                known[c] = route(c)
            small = [bool(near[i] and plain[i] and known[c][1] and sizes[i] <= SMALL_BYTES and rows[i] <= SMALL_ROWS)
                     for i, c in enumerate(columns)]
            kind = ["" if small[i] else known[c][0] for i, c in enumerate(columns)]
            kept = ["path", "bldg_id", "upgrade", "n_rows"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(kind, pa.string()), pa.array(small, pa.bool_())],
                                             [*kept, "kind", "small"])

    return footer.mapInArrow(run, "path string, bldg_id int, upgrade int, n_rows long, kind string, small boolean")


def merged_schema(spark: SparkSession, root: str, folders: list[str]) -> T.StructType | None:
    """The schema that Spark merges from the footers of the folders, or None if their types differ."""
    try:
        return (spark.read.option("basePath", root).option("ignoreCorruptFiles", "true").option("mergeSchema", "true")
                .parquet(*folders).schema)
    except Exception as e:  # noqa: BLE001  raised as a Py4J or a PySpark error, by the place it comes from
        if "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
        return None


# ---- reads ---------------------------------------------------------------------

def _small_reader(fields: list[tuple[str, str]], parted: list[str]):
    """A function for ``mapInArrow`` that reads small files (path, bldg_id, n_rows) whole: the columns ``fields``
    (name, type), the values of the folders ``parted`` as text, and bldg_id. A file that cannot be
    read in full gives no rows."""
    kinds = {n: to_arrow_type(T._parse_datatype_string(t)) for n, t in fields}
    names = [*kinds, *parted, "bldg_id"]

    def column(t: pa.Table, name: str) -> pa.ChunkedArray | pa.Array:
        if name not in t.column_names:
            return pa.nulls(t.num_rows, kinds[name])
        found = t.column(name)
        return found if found.type == kinds[name] else found.cast(kinds[name], safe=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores, held, rows, folders = _Stores(), [], 0, {}
        for b in batches:
            for path, bldg, n in zip(*[b.column(c).to_pylist() for c in ("path", "bldg_id", "n_rows")], strict=True):
                try:
                    with stores.open(path) as f:
                        file = pq.ParquetFile(f)
                        t = file.read([c for c in file.schema_arrow.names if c in kinds], use_threads=False)
                except Exception:  # noqa: BLE001  a damaged file: its status tells
                    continue
                if t.num_rows != n or not n:
                    continue
                folder = path.rsplit("/", 1)[0]
                if folder not in folders:
                    folders[folder] = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
                held.append(pa.Table.from_arrays([*[column(t, c) for c in kinds],
                                                  *[pa.repeat(pa.scalar(_value(folders[folder].get(p)), pa.string()), n) for p in parted],
                                                  pa.repeat(pa.scalar(bldg, pa.int32()), n)], names))
                rows += n
                if rows >= BATCH_ROWS:
                    yield from pa.concat_tables(held).combine_chunks().to_batches()
                    held, rows = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return run


def _value(text: str | None) -> str | None:
    """The value of a folder's name; Spark escapes some characters in it."""
    return None if text is None or text == "__HIVE_DEFAULT_PARTITION__" else unquote(text)


@dataclass
class SeriesFiles:
    """The requested files (a written table: path, bldg_id, upgrade, n_rows, kind, small, part) and how to read
    them. ``parts``: (kind, part, small files, other files); ``parted``: the columns from folders."""

    spark: SparkSession
    root: str
    folders: list[str]
    files: DataFrame
    schema: T.StructType
    parts: list[tuple[str, int, int, int]]
    parted: T.StructType
    strays: bool

    def _read(self, paths: list[str], kind: str, tolerant: bool = True) -> DataFrame:
        own = dict(line.split("\t") for line in kind.split("\n")) if kind else {}
        fields = [T.StructField(f.name, T._parse_datatype_string(own[f.name]) if f.name in own else f.dataType) for f in self.schema]
        raw = (self.spark.read.option("basePath", self.root).option("ignoreCorruptFiles", str(tolerant).lower())
               .schema(T.StructType(fields)).parquet(*paths))
        cast = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in own else F.col(f"`{f.name}`") for f in self.schema]
        rest = [F.col(f"`{c}`") for c in raw.columns if c not in {f.name for f in self.schema}]
        name = F.regexp_extract(F.col("_metadata.file_name"), FILE_ID_PATTERN, 1).try_cast("int")
        return raw.select(*[c for c, f in zip(cast, self.schema, strict=True) if f.name != "bldg_id"], *rest, name.alias("bldg_id"))

    def _read_small(self, files: DataFrame, n: int, measures: set[str] | None = None) -> DataFrame:
        """The readings of ``n`` small files; with ``measures`` (sanitized) no other columns are read, and the others are null."""
        fields = [f for f in self.schema if f.name != "bldg_id"]
        asked = [f for f in fields if measures is None or C.sanitize(f.name) in measures]
        made = T.StructType([*asked, *[T.StructField(p.name, T.StringType()) for p in self.parted],
                             T.StructField("bldg_id", T.IntegerType())])
        read = _small_reader([(f.name, f.dataType.simpleString()) for f in asked], [p.name for p in self.parted])
        out = _dealt(files.select("path", "bldg_id", "n_rows"), n).mapInArrow(read, made)
        return out.select(*[F.col(f"`{f.name}`") if f in asked else F.lit(None).cast(f.dataType).alias(f.name) for f in fields],
                          *[F.col(f"`{p.name}`").cast(p.dataType).alias(p.name) for p in self.parted], "bldg_id")

    def groups(self) -> Iterator[DataFrame]:
        """The readings, one group of files after the other. A file that cannot be read is
        skipped; :meth:`status` tells."""
        for kind, part, small, other in self.parts:
            read = [self._read_small(self._group(kind, part).where("small"), small)] if small or not other else []
            yield reduce(DataFrame.unionByName, [*read, *([self._read_other(kind, part)] if other else [])])

    def _group(self, kind: str, part: int) -> DataFrame:
        return self.files.where((F.col("kind") == kind) & (F.col("part") == part))

    def _read_other(self, kind: str, part: int) -> DataFrame:
        paths = self._group(kind, part).where("NOT small").select("path").collect()
        return self._read([r.path for r in paths], kind)

    def readings(self, measures: set[str] | None = None) -> DataFrame:
        """All readings in one table; of small files only ``measures`` (sanitized names) are read, if given."""
        if not self.parts:
            return self._read(self.folders, "").where(F.lit(False))
        n = sum(small for _, _, small, _ in self.parts)
        small = [self._read_small(self.files.where("small"), n, measures)] if n else []
        return reduce(DataFrame.unionByName, [*small, *[self._read_other(k, p) for k, p, _, other in self.parts if other]])

    @property
    def whole(self) -> bool:
        """Whether every file is read whole or not at all."""
        return not any(other for *_, other in self.parts)

    def expected(self, group: int | None = None) -> DataFrame:
        """(bldg_id, upgrade, n_expected) from the footers, of all files or one of :meth:`groups`."""
        files = self.files if group is None or not self.parts else self._group(*self.parts[group][:2])
        arm = F.regexp_extract("path", r"/upgrade=([^/]*)/", 1).try_cast("int")  # the readings have the folder's
        return files.where("n_rows > 0").groupBy("bldg_id", arm.alias("upgrade")).agg(F.sum("n_rows").alias("n_expected"))

    def status(self, read: DataFrame, expected: DataFrame | None = None) -> DataFrame:
        """(bldg_id, upgrade, n_expected, n_read, cause) of every requested file; ``read`` has the
        counted readings (bldg_id, upgrade, n_read) of a scan of their data, as a written table."""
        keys = ["bldg_id", "upgrade"]
        out = (self.files.select(*keys).distinct().join(self.expected() if expected is None else expected, keys, "left")
               .join(read.select(*keys, "n_read"), keys, "left"))
        out = out.withColumn("n_read", F.coalesce("n_read", F.lit(0).cast("long")))
        cause = (F.when(F.col("n_expected").isNull(), "footer unreadable")
                 .when(F.col("n_expected") != F.col("n_read"), "data unreadable"))
        return out.select(*keys, "n_expected", "n_read", cause.alias("cause"))


def open_files(spark: SparkSession, root: str, folders: list[str], ids: DataFrame | None = None, schema=None,
               bound: int = GROUP_FILES) -> SeriesFiles:
    """The files of ``folders``; with ``ids`` (a table with bldg_id) those of its buildings
    only, found by a join with the listing. Without a schema the footers' types are merged, or
    bound where they differ. With one, files are read by it (types that the reader does not
    widen make a file unreadable)."""
    listing = _named(_listing(spark, root, folders))
    strays = listing.where("bldg_id IS NULL").limit(1).count() > 0
    files = listing.where("bldg_id IS NOT NULL")
    # one path of every folder shows the types of the columns from folders
    some = [r.path for r in files.groupBy(F.regexp_extract("path", r"^(.*)/", 1)).agg(F.min("path").alias("path")).collect()]
    empty = spark.read.option("basePath", root).schema("`_` int").parquet(*some) if some else None
    parted = T.StructType([f for f in empty.schema if f.name != "_"]) if some else T.StructType()
    wanted = None if ids is None else ids.select(F.col("bldg_id").cast("int")).distinct()
    if schema is not None:  # only the footers of the requested files are read
        target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        if wanted is not None:
            files = _written(files.join(wanted, "bldg_id", "left_semi").select("path", "size", "bldg_id", "upgrade"), "series_wanted")
        found = footers(files)
    else:  # over all files of the folders, whatever the ids
        found = footers(files)
        target = _schema(spark, root, folders, found)
        if wanted is not None:
            found = found.join(wanted, "bldg_id", "left_semi")
    shown = {f.name: f.dataType for f in parted}
    target = T.StructType([f for f in target if f.dataType != shown.get(f.name)])  # these come from the folders in any case
    files = _written(_routed(found, target, schema is not None, {f.name for f in parted}), "series_files")
    sizes = {r.kind: r["count"] for r in files.groupBy("kind").count().collect()}  # one row per mix of types
    part = F.lit(0)
    for kind, n in sizes.items():
        part = F.when(F.col("kind") == F.lit(kind), F.pmod(F.xxhash64("path"), F.lit(-(-n // bound))).cast("int")).otherwise(part)
    files = files.withColumn("part", part)
    found = files.groupBy("kind", "part").agg(F.count_if("small").alias("small"), F.count_if(~F.col("small")).alias("other")).collect()
    counted = {(r.kind, r.part): (r.small, r.other) for r in found}
    parts = [(k, p, *counted.get((k, p), (0, 0))) for k, n in sorted(sizes.items()) for p in range(-(-n // bound))]
    return SeriesFiles(spark, root, folders, files, target, parts, parted, strays)


# ---- writing -------------------------------------------------------------------

def _store(path: str) -> tuple[pfs.FileSystem, str]:
    """The file system of a path and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pfs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class SeriesFileWriter(DataSourceArrowWriter):
    """Writes sorted rows of (upgrade, state, bldg_id, ...) as one file per building and arm. A
    file is written below ``_temporary`` and moved into place when it is whole, so repeated
    attempts of a task leave the same files, and a lost one leaves none. Without ``overwrite``
    files are added to the folder (a building and arm that is there already is replaced)."""

    def __init__(self, root: str, overwrite: bool):
        self.root, self.run, self.overwrite = root.rstrip("/"), uuid.uuid4().hex, overwrite
        store, at = _store(self.root)
        if overwrite and store.get_file_info(at).type != pfs.FileType.NotFound:
            store.delete_dir_contents(at)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _store(self.root)
        key, held, rows, out, at, made = None, [], 0, None, None, set()

        def flush(done: bool):
            nonlocal held, rows, out
            if held:
                table = pa.Table.from_batches(held).drop_columns(["upgrade", "state", "bldg_id"])
                if out is None:
                    for folder in {p.rsplit("/", 1)[0] for p in at} - made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    out = pq.ParquetWriter(at[0], table.schema, filesystem=store)
                out.write_table(table)
                held, rows = [], 0
            if done and out is not None:
                out.close()
                store.move(*at)
                out = None

        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in ("upgrade", "state", "bldg_id")], strict=True))
            lo = 0
            while lo < b.num_rows:
                hi = lo
                while hi < b.num_rows and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != key:
                    flush(done=True)
                    key = keys[lo]
                    arm, state, bldg = key
                    at = (f"{root}/_temporary/{self.run}/{uuid.uuid4().hex}",
                          f"{root}/upgrade={arm}/state={state}/{bldg}-{arm}.parquet")
                held.append(b.slice(lo, hi - lo))
                rows += hi - lo
                if rows >= ROW_GROUP:
                    flush(done=False)
                lo = hi
        flush(done=True)
        return WriterCommitMessage()

    def commit(self, messages) -> None:
        self._clear()
        store, root = _store(self.root)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages) -> None:
        """Nothing of a failed job stays; of one that adds to a folder, no partial file."""
        store, root = _store(self.root)
        if self.overwrite and store.get_file_info(root).type != pfs.FileType.NotFound:
            store.delete_dir_contents(root)
        self._clear()

    def _clear(self) -> None:
        store, root = _store(self.root)
        if store.get_file_info(f"{root}/_temporary/{self.run}").type != pfs.FileType.NotFound:
            store.delete_dir(f"{root}/_temporary/{self.run}")


class SeriesFileSource(DataSource):
    """``df.write.format("series_files").mode("overwrite").save(root)``; see :func:`write_files`."""

    @classmethod
    def name(cls) -> str:
        return "series_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> SeriesFileWriter:
        return SeriesFileWriter(self.options["path"], overwrite)


def write_files(df: DataFrame, root: str, overwrite: bool = True) -> str:
    """Write readings (upgrade, state, bldg_id, timestamp, ...) in the source layout. The tasks
    name the files; the driver only marks the end. A file is one task's work, written a row
    group at a time."""
    keys = ("upgrade", "state", "bldg_id")
    df.sparkSession.dataSource.register(SeriesFileSource)
    out = df.repartition(*keys).sortWithinPartitions(*keys, *(["timestamp"] if "timestamp" in df.columns else []))
    out.write.format(SeriesFileSource.name()).mode("overwrite" if overwrite else "append").save(root)
    return root
