"""Every registered query against its DuckDB SQL at sf0.01 (the correctness gate)."""

import pytest

import oracle_harness as H
from conftest import SF001
import __spark_entry__ as E
from loadshift.plans.oracle import ORACLE
from loadshift.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return H.duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = H.compare(QUERIES[name](spark, SF001), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_electricity_savings" in df.columns


@pytest.mark.parametrize("name", ["compare_arms_onepass", "building_hour_compare", "local_hour_dst",
                                  "peak_hour_slice", "prep_baseline"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        ok, msg = H.compare(QUERIES[name](spark, SF001), con, ORACLE[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg
