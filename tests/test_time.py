
import datetime as dt

from pyspark.sql import functions as F

from loadshift.functions import timecols as TC
from loadshift.operators import rollup as R

ZONE = "America/New_York"


def _local_hour(spark, ts_list):
    df = spark.createDataFrame([(t,) for t in ts_list], "ts timestamp_ntz")
    return [r.l for r in df.select(TC.to_local(TC.hour_utc(F.col("ts")), ZONE).alias("l")).collect()]


def test_hour_ending_winter(spark):
    ts = [dt.datetime(2018, 1, 7, 0, 15), dt.datetime(2018, 1, 7, 0, 30), dt.datetime(2018, 1, 7, 0, 45),
          dt.datetime(2018, 1, 7, 1, 0), dt.datetime(2018, 1, 7, 1, 15)]
    got = _local_hour(spark, ts)
    assert got[:4] == [dt.datetime(2018, 1, 7, 0, 0)] * 4
    assert got[4] == dt.datetime(2018, 1, 7, 1, 0)


def test_summer_shifts_to_daylight_time(spark):
    # 16:00 standard time ends the interval 15:45-16:00 -> EDT hour 16:00
    assert _local_hour(spark, [dt.datetime(2018, 7, 2, 16, 0)]) == [dt.datetime(2018, 7, 2, 16, 0)]
    assert _local_hour(spark, [dt.datetime(2018, 7, 2, 16, 15)]) == [dt.datetime(2018, 7, 2, 17, 0)]


def test_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = _local_hour(spark, [dt.datetime(2018, 3, 11, 2, 15), dt.datetime(2018, 11, 4, 1, 15)])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2018, 3, 11, 3, 0), dt.datetime(2018, 11, 4, 1, 0)]


def test_full_year_instants_and_wall_hours(spark):
    start = dt.datetime(2018, 1, 1, 0, 15)
    df = (spark.range(0, 35040).select(
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") * 15))
        .alias("timestamp")))
    inst = R.with_hour(df).groupBy(R.HOUR_UTC).count()
    counts = inst.groupBy("count").count().collect()
    assert {r[0]: r[1] for r in counts} == {4: 8760}
    wall = R.add_wall_clock(inst, ZONE).groupBy(R.TIME_HR).agg(F.sum("count").alias("n"))
    got = {r[0]: r[1] for r in wall.groupBy("n").count().collect()}
    assert got == {4: 8758, 8: 1}
    assert wall.where("n = 8").collect()[0][0] == dt.datetime(2018, 11, 4, 1, 0)


def test_repeated_hour_flag(spark):
    hours = [dt.datetime(2018, 11, 4, h) for h in range(3, 9)]
    df = spark.createDataFrame([(h,) for h in hours], "h timestamp_ntz")
    got = [r.r for r in df.select(TC.is_repeated_local_hour(F.col("h"), ZONE).alias("r")).collect()]
    # 05:00 UTC = 01:00 EDT and 06:00 UTC = 01:00 EST repeat
    assert got == [False, False, True, True, False, False]


def test_raw_window_contains_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 7, 2, 15, 15),), (dt.datetime(2018, 7, 5, 0, 0),)], "ts timestamp_ntz")
    got = [r.w for r in df.select(TC.raw_window_for_local_hour(F.col("ts"), "2018-07-02 16:00:00").alias("w")).collect()]
    assert got == [True, False]


def test_r_datetime_text(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 7, 2, 0, 0),), (dt.datetime(2018, 7, 2, 17, 0),)], "t timestamp_ntz")
    got = [r.s for r in df.select(TC.r_datetime_text(F.col("t")).alias("s")).collect()]
    assert got == ["2018-07-02", "2018-07-02 17:00:00"]


def test_zone_guard():
    import pytest
    from loadshift.config import JobParams
    assert TC.check_whole_hour_zone("America/Chicago") == "America/Chicago"
    with pytest.raises(ValueError, match="not whole hours"):
        TC.check_whole_hour_zone("Asia/Kolkata")
    with pytest.raises(ValueError):
        JobParams(timezone="Asia/Kolkata")
