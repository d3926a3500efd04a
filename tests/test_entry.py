"""The driver contract of __spark_entry__.py."""

import os
import re
import subprocess
import sys

import __spark_entry__ as E
from loadshift.plans.oracle import ORACLE
from loadshift.plans.queries import QUERIES


def test_entry_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and a.count() > 0


def test_query_and_oracle_keys():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())
    q, o = QUERIES, ORACLE
    assert set(q) == set(o) and len(q) >= 30
    for name in q:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
        assert "pipeline" not in name and not re.match(r"op\d+_", name), name
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s.strip() for s in o.values())


def test_base_queries_stay_without_an_optional_package():
    """A package that only the training-data operators need may be absent."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as E; print(sorted(E.queries()) == sorted(E.QUERIES))"
    root = os.path.dirname(os.path.abspath(E.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.split()[-1] in ("True", "False"), done.stderr
    if os.path.isdir(os.path.join(root, "loadshift", "llm")):
        assert done.stdout.split()[-1] == "True" and "left out" in done.stderr
