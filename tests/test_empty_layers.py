"""Layers without rows, reruns without input, types of partition values, and late stream rows."""

from strata import schemas
from strata.operators import gold, locations, quality, silver
from strata.plans import medallion
from strata.session import scratch_path
from strata.sinks import writers
from strata.sources import fixtures, landing, payloads
from strata.streaming import streams
from tests.conftest import rows


def test_bronze_job_keeps_the_table_when_nothing_landed(spark, sf_small):
    base = scratch_path(spark, "test-bronze-keep")
    landing.write_landing_json(fixtures.traffic_raw(spark, sf_small), f"{base}/land")
    first = medallion.bronze_job(spark, f"{base}/land", f"{base}/bronze", schemas.TRAFFIC_SCHEMA,
                                 multi_line=False)
    again = medallion.bronze_job(spark, f"{base}/gone", f"{base}/bronze", schemas.TRAFFIC_SCHEMA,
                                 multi_line=False)
    assert again["skipped"] and first["rows"] == spark.read.parquet(f"{base}/bronze").count()


def test_all_rows_rejected_and_no_hourly_match(spark, sf_small):
    base = scratch_path(spark, "test-all-rejected")
    bad = fixtures.traffic_raw(spark, sf_small).selectExpr(
        *[f"-1.0D as {c}" if c == "current_speed" else c for c in
          fixtures.traffic_raw(spark, sf_small).columns])
    frame = medallion.bronze_frame(bad, stamp_ingestion=False)
    writers.write_layer(frame, f"{base}/bronze")
    out = medallion.silver_job(spark, f"{base}/bronze", f"{base}/silver", quality.traffic_rules(),
                               schema=frame.schema)
    assert out["rows"] == 0 and out["rows_in"] == frame.count()
    assert sum(out["rejects"].values()) + out["duplicates"] == out["rows_in"]
    table = silver.silver_traffic(frame).schema
    assert landing.read_table(spark, f"{base}/silver", table).count() == 0


def test_gold_job_falls_back_when_no_hour_matches(spark, sf_small):
    base = scratch_path(spark, "test-fallback")
    traffic = silver.silver_traffic(fixtures.traffic_raw(spark, sf_small))
    weather = silver.silver_weather(fixtures.weather_raw(spark, sf_small, year_shift=1))
    writers.write_layer(traffic, f"{base}/t")
    writers.write_layer(weather, f"{base}/w")
    out = medallion.gold_job(spark, f"{base}/t", f"{base}/w", f"{base}/m", f"{base}/a",
                             silver_tables=(traffic.schema, weather.schema))
    want = gold.kpi_rollup(gold.feature_mart(traffic, weather, fallback="global"), order_by=None)
    got = writers.read_layer(spark, f"{base}/a", schemas.ANALYTICS_SCHEMA)
    assert out["mart_rows"] > 0 and rows(got.select(*want.columns)) == rows(want)


def test_numeric_location_names_stay_text(spark, sf_small):
    layout = medallion.Layout(scratch_path(spark, "test-names"))
    for topic, frame in ((layout.traffic_topic, fixtures.traffic_raw(spark, sf_small)),
                         (layout.weather_topic, fixtures.weather_raw(spark, sf_small))):
        landing.write_landing_json(frame.replace({"ASIA": "007"}, subset=["city_name"]),
                                   layout.landing(topic))
    medallion.medallion_run(spark, layout, multi_line=False, stamp_ingestion=False, train=False,
                            export=False)
    got = writers.read_layer(spark, layout.analytics, schemas.ANALYTICS_SCHEMA)
    assert got.where("city_name = '007'").count() > 0


def test_stream_merge_loses_no_late_row(spark, sf_small):
    base = scratch_path(spark, "test-late")
    events = fixtures.traffic_raw(spark, sf_small)
    landing.write_landing_json(events.repartition(3, "event_id"), f"{base}/land")
    stream = streams.landing_stream(spark, f"{base}/land", events.schema, max_files_per_trigger=1)
    tables = streams.silver_tables(spark, f"{base}/silver", events.schema)
    streams.run_silver_refresh(stream, quality.traffic_rules(), tables, f"{base}/ck")
    want = silver.silver_traffic(events, processed_col=None)
    got = tables.read("silver").select(*want.columns)
    assert rows(got) == rows(want)


def test_dedup_survivors_do_not_depend_on_processing_time(spark):
    base = [("c", "2024-01-01T00:00:00", float(v)) for v in range(20)]
    for stamp in ("a", "b"):
        df = spark.createDataFrame([(*r, f"{stamp}{i}") for i, r in enumerate(base)],
                                   "city_name string, timestamp string, v double, "
                                   "ingestion_timestamp string")
        kept = quality.dedup(df, ["city_name", "timestamp"], tie_break=True).first().v
        first = kept if stamp == "a" else first
        assert kept == first


def test_location_lookup_does_not_fan_out(spark):
    dim = spark.createDataFrame([("Airport", "x", 1.0, 2.0, 3), ("AIRPORT", "y", 1.0, 2.0, 3)],
                                "name string, area_type string, lat double, lon double, zoom int")
    events = spark.createDataFrame([("airport", 1)], "city_name string, e int")
    assert locations.enrich_locations(events, dim).count() == 1


def test_payload_numbers_truncate_and_wrong_types_are_reported(spark):
    bodies = ['{"flowSegmentData": {"currentSpeed": 30.5, "freeFlowSpeed": 50, '
              '"currentTravelTime": 12.7, "freeFlowTravelTime": 9}}',
              '{"flowSegmentData": {"currentSpeed": "abc", "freeFlowSpeed": 50}}',
              '{"flowSegmentData": "oops"}', "not json"]
    raw = spark.createDataFrame(
        [(i, "c", 1.0, 2.0, None, b) for i, b in enumerate(bodies)],
        "poll_id long, city_name string, latitude double, longitude double, "
        "fetched_at timestamp, body string")
    got = {r.poll_id: r for r in payloads.flatten_traffic(raw).collect()}
    assert got[0].current_travel_time == 12 and got[0].payload_error is None
    assert got[0].confidence == 1.0  # absent: the default
    assert got[1].current_speed is None and got[1].payload_error == payloads.WRONG_TYPE
    assert got[2].current_speed is None and got[2].payload_error == payloads.WRONG_TYPE
    assert got[3].current_speed is None and got[3].payload_error == payloads.UNPARSABLE
