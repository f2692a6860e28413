"""Dedup, quality rules and row accounting."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import quality, silver
from strata.operators.quality import Order
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
T1 = dt.datetime(2024, 1, 1, 8, 1, 0)
SCHEMA = ("event_id long, city_name string, timestamp string, current_speed double, "
          "free_flow_speed double, ingestion_timestamp timestamp_ntz")


def test_dedup_keeps_earliest_ingestion(spark):
    df = spark.createDataFrame([
        (1, "A", "2024-01-01T08:00:00+00:00", 30.0, 40.0, T1),
        (1, "A", "2024-01-01T08:00:00+00:00", 31.0, 40.0, T0),
        (2, None, "2024-01-01T08:00:00+00:00", 10.0, 40.0, T0),
        (3, None, "2024-01-01T08:00:00+00:00", 11.0, 40.0, T0),
    ], SCHEMA)
    for method in ("window", "aggregate"):
        out = quality.dedup(df, ["city_name", "timestamp"], silver.FIRST_INGESTED, method=method)
        assert rows(out, "event_id", "city_name", "current_speed") == [(1, "A", 31.0), (2, None, 10.0)]


def test_bad_survivor_removes_good_copy_unless_filter_first(spark):
    df = spark.createDataFrame([
        (1, "A", "2024-01-01T08:00:00+00:00", -1.0, 40.0, T0),
        (1, "A", "2024-01-01T08:00:00+00:00", 30.0, 40.0, T1),
    ], SCHEMA)
    assert silver.silver_traffic(df).count() == 0
    assert rows(silver.silver_traffic(df, filter_first=True), "current_speed") == [(30.0,)]


def test_traffic_bounds(spark):
    df = spark.createDataFrame([
        (i, "A", f"2024-01-01T08:00:0{i}+00:00", cs, fs, T0)
        for i, (cs, fs) in enumerate([(0.0, 1.0), (-0.1, 1.0), (5.0, 0.0), (5.0, 0.1), (None, 1.0)])
    ], SCHEMA)
    out = quality.apply_rules(df, quality.traffic_rules())
    assert rows(out, "event_id") == [(0,), (3,)]


def test_weather_bounds(spark):
    base = dict(temperature=20.0, humidity=50, aqi=3, pm2_5=1.0)
    cases = [("temperature", -50.0, True), ("temperature", 60.0, True), ("temperature", 60.1, False),
             ("humidity", 0, True), ("humidity", 100, True), ("humidity", None, False),
             ("aqi", 0, False), ("aqi", 1, True), ("aqi", 5, True), ("aqi", 6, False),
             ("pm2_5", 0.0, True), ("pm2_5", -0.1, False), ("pm2_5", None, False)]
    data = []
    for i, (col, val, _) in enumerate(cases):
        r = dict(base, **{col: val})
        data.append((i, "A", f"t{i}", r["temperature"], r["humidity"], r["aqi"], r["pm2_5"]))
    df = spark.createDataFrame(data, "event_id long, city_name string, timestamp string, temperature double, "
                                     "humidity int, aqi int, pm2_5 double")
    kept = {r[0] for r in quality.apply_rules(df, quality.weather_rules()).select("event_id").collect()}
    assert kept == {i for i, (_, _, ok) in enumerate(cases) if ok}


def test_row_accounting_partitions_the_input(spark):
    df = spark.createDataFrame([
        (1, "A", "t1", 30.0, 40.0, T0), (1, "A", "t1", 31.0, 40.0, T1),
        (2, "A", "t2", None, 40.0, T0), (3, "A", "t3", -2.0, 40.0, T0), (4, "A", "t4", 5.0, 0.0, T0),
        (5, "B", "t5", 5.0, 9.0, T0),
    ], SCHEMA)
    out = dict((r.outcome, r.rows) for r in quality.row_accounting(
        df, ["city_name", "timestamp"], silver.FIRST_INGESTED, quality.traffic_rules(), "traffic").collect())
    assert out == {"input": 6, "duplicate": 1, "output": 2, "required:current_speed": 1,
                   "current_speed>=0.0": 1, "free_flow_speed>0.0": 1}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=30))
def test_dedup_is_idempotent_and_unique(spark, data):
    df = spark.createDataFrame([(i, f"c{a}", f"t{b}", float(v)) for i, (a, b, v) in enumerate(data)],
                               "event_id long, city_name string, timestamp string, v double")
    order = [Order("v", False), Order("event_id", True)]
    once = quality.dedup(df, ["city_name", "timestamp"], order)
    twice = quality.dedup(once, ["city_name", "timestamp"], order)
    assert rows(once) == rows(twice)
    assert once.count() == len({(a, b) for a, b, _ in data})
    agg = quality.dedup(df, ["city_name", "timestamp"], [Order("v", False), Order("event_id", False)], method="aggregate")
    win = quality.dedup(df, ["city_name", "timestamp"], [Order("v", False), Order("event_id", False)], method="window")
    assert rows(agg) == rows(win)
    # Without a unique id in the order, the row hash makes both forms pick the same survivor.
    agg = quality.dedup(df, ["city_name", "timestamp"], [Order("v", False)], method="aggregate", tie_break=True)
    win = quality.dedup(df, ["city_name", "timestamp"], [Order("v", False)], method="window", tie_break=True)
    assert rows(agg) == rows(win)
