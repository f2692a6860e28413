"""Timestamp parsing and calendar features.

Calendar parts are computed for an explicit zone and do not depend on the session time zone:
the parsed instant is turned into the wall-clock time of ``tz`` as a ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Days reported by dayofweek: 1 = Sunday ... 7 = Saturday.
WEEKEND_DAYS = (1, 7)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(text) -> Column:
    """ISO-8601 text (with or without offset) to a timestamp; unparsable text gives null."""
    return F.try_to_timestamp(_col(text))


def wall_clock(instant, tz: str = "UTC") -> Column:
    """Wall-clock time of ``tz`` at ``instant`` as TIMESTAMP_NTZ, independent of the session zone."""
    shifted = F.from_utc_timestamp(_col(instant), tz)
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", F.unix_micros(shifted), epoch)


def temporal_parts(instant, tz: str = "UTC", weekend_days=WEEKEND_DAYS) -> dict[str, Column]:
    """hour, day_of_week (1 = Sunday), day_of_month, month, year and is_weekend for ``tz``."""
    return parts_of_wall_clock(wall_clock(instant, tz), weekend_days)


def parts_of_wall_clock(local, weekend_days=WEEKEND_DAYS) -> dict[str, Column]:
    """Calendar parts of a TIMESTAMP_NTZ wall-clock column."""
    local = _col(local)
    dow = F.dayofweek(local)
    return {
        "hour": F.hour(local),
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(local),
        "month": F.month(local),
        "year": F.year(local),
        "is_weekend": F.when(dow.isin(*weekend_days), F.lit(1)).otherwise(F.lit(0)),
    }


def iso_utc_text(ts=None) -> Column:
    """ISO-8601 text with microseconds and a ``+00:00`` offset.

    ``ts`` is a TIMESTAMP_NTZ holding UTC wall-clock time; ``None`` stamps the current time.
    The text comes from the zone-free cast of the NTZ value (``yyyy-MM-dd HH:mm:ss[.ffffff]``,
    trailing zeros dropped), so it never passes through the session zone, where a wall-clock
    time inside a daylight-saving gap would shift.
    """
    if ts is None:
        ts = wall_clock(F.current_timestamp(), "UTC")
    s = _col(ts).cast("string")
    return F.concat(F.substring(s, 1, 10), F.lit("T"), F.substring(s, 12, 8), F.lit("."),
                    F.rpad(F.substring(s, 21, 6), 6, "0"), F.lit("+00:00"))
