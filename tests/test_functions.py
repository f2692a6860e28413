"""Scalar column functions: rounding, calendar parts, traffic and weather metrics."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions.metrics import (congestion_level, congestion_ratio, delay_seconds,
                                      predicted_congestion_index, severity_index, speed_ratio)
from strata.functions.rounding import round_half_even, round_half_up
from strata.operators.layers import add_temporal_features


def test_rounding_half_up_and_half_even(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-1.005,)], "x double")
    out = df.select(round_half_up("x", 2).alias("u"), round_half_even("x", 2).alias("e")).collect()
    assert [(r.u, r.e) for r in out] == [(1.01, 1.0), (2.68, 2.68), (0.13, 0.12), (-1.01, -1.0)]


def test_timestamp_parse_boundaries(spark):
    texts = ["2024-01-06T23:59:59+00:00", "2024-01-06T23:59:59+05:30", "2024-01-06T23:59:59Z",
             "not a date", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    out = add_temporal_features(df, "timestamp", "UTC").collect()
    # +00:00 and Z: Saturday 23:59:59 UTC; +05:30 is 18:29:59 UTC the same day.
    assert (out[0].hour, out[0].day_of_week, out[0].is_weekend) == (23, 7, 1)
    assert (out[1].hour, out[1].day_of_month) == (18, 6)
    assert out[2].hour == 23
    for r in out[3:]:
        assert r.event_timestamp is None and r.hour is None and r.is_weekend == 0


def test_calendar_parts_follow_the_given_zone_not_the_session(spark):
    df = spark.createDataFrame([("2024-01-06T23:59:59+00:00",), ("2024-01-07T00:00:00+00:00",)], "timestamp string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        utc = add_temporal_features(df, "timestamp", "UTC").collect()
        ist = add_temporal_features(df, "timestamp", "Asia/Kolkata").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [(r.hour, r.day_of_week, r.is_weekend) for r in utc] == [(23, 7, 1), (0, 1, 1)]
    # Saturday 23:59:59 UTC is Sunday 05:29:59 in India; Sunday 00:00 UTC is Sunday 05:30.
    assert [(r.hour, r.day_of_week) for r in ist] == [(5, 1), (5, 1)]


def test_severity_index(spark):
    conds = ["Thunderstorm", "Snow", "Heavy Rain", "Rain", "Drizzle", "Fog", "Mist", "Clouds", "Haze",
             "Clear", "rain", "Tornado", None]
    df = spark.createDataFrame([(c,) for c in conds], "weather_condition string")
    got = [r[0] for r in df.select(severity_index()).collect()]
    assert got == [3, 3, 3, 2, 2, 2, 2, 1, 1, 0, 0, 0, 0]


def test_speed_ratio_and_delay(spark):
    df = spark.createDataFrame([(60.0, 40.0, 100, 120), (30.0, 40.0, 200, None), (10.0, 3.0, 50, 20)],
                               "cs double, fs double, ct int, ft int")
    out = df.select(speed_ratio("cs", "fs").alias("r"), delay_seconds("ct", "ft").alias("d")).collect()
    assert [(r.r, r.d) for r in out] == [(1.5, 0), (0.75, 0), (3.3333, 30)]


def test_congestion_level_thresholds_use_the_rounded_ratio(spark):
    df = spark.createDataFrame([(85.0, 100.0), (84.99, 100.0), (55.0, 100.0), (54.94, 100.0),
                                (120.0, 100.0), (5.0, 0.5)], "cs double, fs double")
    out = df.withColumn("r", congestion_ratio("cs", "fs")).withColumn("lvl", congestion_level("r")).collect()
    assert [(r.r, r.lvl) for r in out] == [(0.85, "Low"), (0.85, "Low"), (0.55, "Medium"),
                                           (0.549, "High"), (1.2, "Low"), (5.0, "Low")]


def test_predicted_congestion_index_is_clamped(spark):
    df = spark.createDataFrame([(70.0, 60.0), (-5.0, 60.0), (10.0, 0.0), (30.0, 60.0)], "p double, f double")
    got = [r[0] for r in df.select(predicted_congestion_index("p", "f")).collect()]
    assert got == [0.0, 100.0, 0.0, 50.0]


def test_iso_text_round_trip(spark):
    from strata.functions.temporal import iso_utc_text
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 16, 6, 738090),)], "ts timestamp_ntz")
    assert df.select(iso_utc_text("ts")).first()[0] == "2024-01-01T00:16:06.738090+00:00"
    assert df.select(iso_utc_text().alias("now")).select(F.length("now")).first()[0] == 32


def test_iso_text_ignores_the_session_zone(spark):
    from strata.functions.temporal import iso_utc_text
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 1, 5),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # 02:30 falls in its DST gap
        assert df.select(iso_utc_text("ts")).first()[0] == "2024-03-10T02:30:01.000005+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_text_without_offset_is_read_in_the_session_zone(spark):
    df = spark.createDataFrame([("2024-01-06 23:59:59",)], "timestamp string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert add_temporal_features(df, "timestamp", "UTC").first().hour == 23
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        # 23:59:59 in India is 18:29:59 UTC.
        assert add_temporal_features(df, "timestamp", "UTC").first().hour == 18
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
