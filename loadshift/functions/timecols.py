"""

Raw readings carry a zone-less timestamp that is Eastern *standard* time and
marks the END of a 15-minute interval. The reference turns it into an hour
bucket in three steps: shift by +5 h (to UTC), shift by -5 min (so that 01:00
falls into hour 0), floor to the hour, and read the wall clock in the local
zone (America/New_York, with daylight saving).

Only the first two steps touch every row; the floor is built from the fields
of the shifted value so that it never depends on the session time zone (T18).
The zone conversion is meant to run *after* aggregation, on the hour keys.

Flooring the UTC instant equals flooring the local time only when the zone's
offsets are whole hours (all US zones, including the reference's); other zones
are rejected by :func:`check_whole_hour_zone` rather than grouped wrongly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
DEFAULT_ZONE = "America/New_York"
SOURCE_UTC_OFFSET_HOURS = 5      # the file clock is UTC-5 (Eastern standard time)
HOUR_ENDING_SHIFT_MINUTES = 5    # readings mark the interval end


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def shifted_instant(ts, offset_hours: int = SOURCE_UTC_OFFSET_HOURS,
                    ending_minutes: int = HOUR_ENDING_SHIFT_MINUTES) -> Column:
    """UTC instant of a reading, moved back into the interval it ends."""
    return (_c(ts) + F.make_dt_interval(F.lit(0), F.lit(offset_hours), F.lit(0), F.lit(0))
            - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(ending_minutes), F.lit(0)))


def floor_hour(x) -> Column:
    """Floor a TIMESTAMP_NTZ to the hour, independent of the session zone."""
    c = _c(x)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def hour_utc(ts, offset_hours: int = SOURCE_UTC_OFFSET_HOURS,
             ending_minutes: int = HOUR_ENDING_SHIFT_MINUTES) -> Column:
    """The hour bucket (a UTC instant, zone-less type) that a reading belongs to."""
    return floor_hour(shifted_instant(ts, offset_hours, ending_minutes))


def check_whole_hour_zone(zone: str, years=range(1970, 2041)) -> str:
    """Raise for a zone whose UTC offset is not a whole number of hours (checked in
    January and July over ``years``, driver-side, no data involved)."""
    import datetime as _dt
    from zoneinfo import ZoneInfo
    z = ZoneInfo(zone)
    for y in years:
        for m in (1, 7):
            off = _dt.datetime(y, m, 15, 12, tzinfo=z).utcoffset()
            if off.total_seconds() % 3600:
                raise ValueError(f"{zone}: offset {off} is not whole hours; hour buckets would be wrong")
    return zone


def to_local(hour_utc_col, zone: str = DEFAULT_ZONE) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant (both zone-less)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(hour_utc_col))


def is_repeated_local_hour(hour_utc_col, zone: str = DEFAULT_ZONE) -> Column:
    """TRUE for the two instants whose wall clock repeats at the fall-back change."""
    h = _c(hour_utc_col)
    one = F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0))
    here = to_local(h, zone)
    return (here == to_local(h + one, zone)) | (here == to_local(h - one, zone))


def wall_parts(local_col) -> dict[str, Column]:
    """year / month / day / hour of a wall-clock timestamp (as the reference's output ints)."""
    c = _c(local_col)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c)}


def make_wall_hour(year, month, day, hour) -> Column:
    """wall-clock timestamp from its parts."""
    return F.make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


def raw_window_for_local_hour(ts, local_hour: str | dt.datetime, slack: dt.timedelta = dt.timedelta(days=1)) -> Column:
    """A redundant range predicate on the RAW timestamp that contains every reading
    of the given local wall-clock hour. It lets parquet skip row groups; the exact
    test is applied on the hour key."""
    if isinstance(local_hour, str):
        local_hour = dt.datetime.fromisoformat(local_hour)
    lo = local_hour - slack
    hi = local_hour + slack
    c = _c(ts)
    return (c >= ntz_literal(lo)) & (c < ntz_literal(hi))


def raw_window_for_local_day(ts, day: str | dt.date, slack: dt.timedelta = dt.timedelta(days=1)) -> Column:
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    start = dt.datetime.combine(day, dt.time())
    c = _c(ts)
    return (c >= ntz_literal(start - slack)) & (c < ntz_literal(start + dt.timedelta(days=1) + slack))


def ntz_literal(value: str | dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so no process or session zone applies."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def r_datetime_text(x) -> Column:
    """Datetime as text the way the reference writes it -- date only at
    midnight, date and time otherwise."""
    c = _c(x)
    midnight = (F.hour(c) == 0) & (F.minute(c) == 0) & (F.second(c) == 0)
    return F.when(midnight, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
