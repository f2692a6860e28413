"""Day tables that change together (ST4, ST6): empty days, crashes, replays, pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import gold, quality, silver
from strata.session import scratch_path
from strata.sinks import snapshots
from strata.sources import fixtures
from strata.streaming import streams
from tests.conftest import rows

FIELDS = [("event_id", schemas.L), ("ingestion_timestamp", schemas.T.TimestampNTZType())]
SCHEMA = schemas.with_fields(schemas.TRAFFIC_SCHEMA, FIELDS)


def events(spark, *given):
    """(event_id, timestamp text, speed, ingestion minute) as traffic events of location "007"."""
    made = [{"event_id": i, "timestamp": ts, "city_name": "007", "current_speed": v, "free_flow_speed": 50.0,
             "ingestion_timestamp": dt.datetime(2024, 1, 1, 0, m)} for i, ts, v, m in given]
    return spark.createDataFrame(made, SCHEMA)


def silver_rows(tables):
    return rows(tables.read("silver"), "event_id", "city_name", "event_day")


@pytest.fixture
def group(spark):
    tables = streams.silver_tables(spark, scratch_path(spark, "test-days"), SCHEMA)
    return tables, streams.silver_refresh_batch(tables, quality.traffic_rules(), "w")


def test_a_day_that_loses_its_only_accepted_row_vanishes(spark, group):
    tables, refresh = group
    refresh(events(spark, (1, "2024-01-01T05:00:00", 30.0, 5), (2, "2024-01-02T05:00:00", 30.0, 5)), 0)
    assert silver_rows(tables) == [(1, "007", "2024-01-01"), (2, "007", "2024-01-02")]
    refresh(events(spark, (3, "2024-01-01T05:00:00", -1.0, 1)), 1)  # ingested earlier, and rejected
    assert silver_rows(tables) == [(2, "007", "2024-01-02")]
    assert rows(tables.read("survivors"), "event_id") == [(2,), (3,)]


def test_a_crash_between_the_tables_leaves_the_last_snapshot(spark, group, monkeypatch):
    tables, refresh = group
    refresh(events(spark, (1, "2024-01-01T05:00:00", 30.0, 5)), 0)
    second = events(spark, (3, "2024-01-01T05:00:00", 40.0, 1), (4, "2024-01-03T05:00:00", 40.0, 1))
    write, calls = snapshots.write_layer, []

    def failing(df, path, **options):
        calls.append(path)
        if "/silver/version=" in path:
            raise OSError("lost")
        write(df, path, **options)

    monkeypatch.setattr(snapshots, "write_layer", failing)
    with pytest.raises(OSError):
        refresh(second, 1)
    assert len(calls) == 2  # the survivors had been written
    assert silver_rows(tables) == [(1, "007", "2024-01-01")] and rows(tables.read("survivors"), "event_id") == [(1,)]
    monkeypatch.undo()
    refresh(second, 1)
    assert silver_rows(tables) == [(3, "007", "2024-01-01"), (4, "007", "2024-01-03")]
    version = tables.current()
    refresh(second, 1)  # replayed after its commit
    assert tables.current() == version and len(silver_rows(tables)) == 2


def test_events_without_a_time_keep_their_rows(spark, group):
    tables, refresh = group
    for epoch in (0, 1):
        refresh(events(spark, (1, "no time", 30.0, 5), (2, "2024-01-02T05:00:00", 30.0, 5)), epoch)
    assert silver_rows(tables) == [(1, "007", "none"), (2, "007", "2024-01-02")]


def test_vacuum_keeps_what_snapshots_name(spark, group):
    tables, refresh = group
    for epoch in range(4):
        refresh(events(spark, (epoch, "2024-01-01T05:00:00", 30.0, 9 - epoch)), epoch)
    refresh(events(spark, (9, "2024-01-02T05:00:00", 30.0, 5)), 4)
    before = silver_rows(tables)
    assert tables.vacuum(keep=1) == 6  # three old versions of the first day in two tables
    assert silver_rows(tables) == before == [(3, "007", "2024-01-01"), (9, "007", "2024-01-02")]
    refresh(events(spark, (10, "2024-01-01T05:00:00", 30.0, 0)), 5)
    assert silver_rows(tables) == [(10, "007", "2024-01-01"), (9, "007", "2024-01-02")]


def test_reads_of_some_days_prune_by_folder(spark, group):
    tables, refresh = group
    refresh(events(spark, *[(d, f"2024-01-{d:02d}T05:00:00", 30.0, 5) for d in range(1, 20)]), 0)
    days = snapshots.stored(spark.createDataFrame([("2024-01-03",), ("2024-01-07",)], "event_day string"))
    found = tables.read("silver", days)
    assert rows(found, "event_id") == [(3,), (7,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "current_speed" in line)
    assert "dynamicpruning" in scan and "event_day" in scan.split("PartitionFilters")[1]


def test_gold_refresh_rebuilds_touched_days_alone(spark, sf_small):
    base = scratch_path(spark, "test-refresh")
    traffic, weather = fixtures.traffic_raw(spark, sf_small), fixtures.weather_raw(spark, sf_small)
    t = streams.silver_tables(spark, f"{base}/t", traffic.schema)
    w = streams.silver_tables(spark, f"{base}/w", weather.schema)
    fill_t = streams.silver_refresh_batch(t, quality.traffic_rules(), "t")
    fill_w = streams.silver_refresh_batch(w, quality.weather_rules(), "w")
    tables = streams.gold_tables(t, w, f"{base}/g")
    read = lambda: spark.read.schema(schemas.ANALYTICS_SCHEMA).parquet(f"{base}/a")

    def refresh():
        streams.run_gold_refresh(t, w, tables, f"{base}/a", f"{base}/ck")

    fill_w(weather, 0)
    refresh()
    assert read().count() == 0  # nothing matches yet, and the query goes on
    first = traffic.where(F.substring("timestamp", 9, 2).cast("int") % 2 == 0)
    fill_t(first, 0)
    refresh()
    versions = dict(tuple(r) for r in tables.manifest().collect())
    fill_t(traffic.join(first, "event_id", "left_anti"), 1)
    refresh()
    later = dict(tuple(r) for r in tables.manifest().collect())
    even = [d for d in versions if int(d[-2:]) % 2 == 0]
    touched = rows(first.select(F.substring("timestamp", 1, 10).alias("d")).distinct(), "d")
    assert all(later[d] == versions[d] for d in even) and {d for d, in touched} <= set(even)
    want = gold.kpi_rollup(gold.feature_mart(silver.silver_traffic(traffic), silver.silver_weather(weather),
                                             fallback="none"), order_by=None)
    assert rows(read().select(*want.columns)) == rows(want)
