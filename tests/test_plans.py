"""Plan assertions: one scan, partial aggregation before one shuffle, no Python UDF,
broadcast where the side is bounded, top-k before the shuffle."""

from loadshift.plans import queries as Q
import fixtures as FX

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def leaves(spark, build):
    """Leaf operators of the physical plan tree (subqueries sit in expressions,
    not in the tree); AQE off so that stages are not leaves."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = build()._jdf.queryExecution().executedPlan()
        it = plan.collectLeaves().iterator()
        out = []
        while it.hasNext():
            out.append(it.next().nodeName())
        return out
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_onepass_compare_single_scan_no_python(spark):
    df = Q.QUERIES["compare_arms_onepass"](spark, SF)
    p = plan_of(df)
    assert leaves(spark, lambda: Q.QUERIES["compare_arms_onepass"](spark, SF)) == ["Scan parquet "]
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert "partial_sum" in p or "partial_count" in p


def test_peak_slice_prefilter_pushed_to_scan(spark):
    df = Q.QUERIES["peak_hour_slice"](spark, SF)
    p = plan_of(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_scenario_report_broadcasts_bounded_sides(spark):
    df = Q.QUERIES["scenario_report"](spark, "/root/testdata/sf0.01")
    df.collect()
    p = plan_of(df)
    assert "BroadcastHashJoin" in p and p.split("== Initial Plan ==")[0].count("events.parquet") == 1


def test_no_python_udf_anywhere(spark):
    for name, fn in Q.QUERIES.items():
        if name == "csv_roundtrip":
            continue
        p = plan_of(fn(spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p, name


def test_fall_back_merge_reuses_the_cube_shuffle(spark, fixture_dir):
    from loadshift.operators import rollup as R
    from loadshift.sources import files as IO
    s = IO.read_series(spark, f"{fixture_dir}/series", (0,), "VA", schema=FX.SERIES_SCHEMA, check=False)
    df = R.hourly_by_building(s, "baseline")
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "ReusedExchange" in final
    # the time zone is converted on hour keys, never on raw readings: nothing
    # between the scan and the first exchange above it converts zones
    lines = final.splitlines()
    i = next(k for k, ln in enumerate(lines) if "FileScan parquet" in ln)
    while "Exchange" not in lines[i]:
        assert "convert_timezone" not in lines[i]
        i -= 1


def test_onepass_has_no_join_and_slice_is_broadcast(spark):
    from loadshift.plans.inspect import plan_summary
    s = plan_summary(Q.QUERIES["compare_arms_onepass"](spark, "/root/testdata/sf0.01"))
    assert s["broadcast_joins"] == s["sort_merge_joins"] == s["shuffled_hash_joins"] == s["nested_loop_joins"] == 0
    s = plan_summary(Q.QUERIES["peak_hour_slice"](spark, "/root/testdata/sf0.01"))
    assert s["broadcast_joins"] >= 1 and s["sort_merge_joins"] == 0 and s["nested_loop_joins"] == 0


def test_no_cross_or_nested_loop_joins_anywhere(spark):
    """No query pairs rows without an equi-key (cartesian / nested-loop joins)."""
    from loadshift.plans.inspect import plan_summary
    for name, fn in Q.QUERIES.items():
        s = plan_summary(fn(spark, SF))
        assert s["nested_loop_joins"] == 0, name
        assert s["python_udfs"] == 0, name
