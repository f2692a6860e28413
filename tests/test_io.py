"""Sources and sinks: payload flattening (S11-S13, J3), landing JSON (S1, S5), CSV export (K5),
topic fan-out (K6, K7, ST1), landing fallback (K8), layer publish and manifest (K9, K10)."""

import json

from strata import schemas
from strata.sinks import landing_zone, writers
from strata.sources import landing, payloads
from strata.session import scratch_path
from strata.streaming import streams
from tests.conftest import rows

LAND = "city_name string, latitude double, longitude double, poll_id long, body string, fetched_at timestamp_ntz"


def land(spark, bodies):
    import datetime as dt
    return spark.createDataFrame([("A", 19.0, 72.8, i, b, dt.datetime(2024, 1, 1, 8, 0, i)) for i, b in enumerate(bodies)], LAND)


def test_traffic_payload_defaults_and_rejects(spark):
    bodies = [
        json.dumps({"flowSegmentData": {"currentSpeed": 30.0, "freeFlowSpeed": 40.0, "currentTravelTime": 120,
                                        "freeFlowTravelTime": 90, "confidence": 0.9, "roadClosure": True}}),
        json.dumps({"flowSegmentData": {"freeFlowSpeed": 40.0}}),             # absent fields
        json.dumps({"flowSegmentData": {"currentSpeed": None, "freeFlowSpeed": None}}),  # explicit nulls
        "<html>not json</html>",
    ]
    out = {r.poll_id: r for r in payloads.flatten_traffic(land(spark, bodies)).collect()}
    assert (out[0].current_speed, out[0].congestion_ratio, out[0].congestion_level, out[0].road_closure) == (30.0, 0.75, "Medium", True)
    assert (out[1].current_speed, out[1].current_travel_time, out[1].confidence, out[1].road_closure) == (0.0, 0, 1.0, False)
    assert (out[2].current_speed, out[2].free_flow_speed, out[2].congestion_level) == (0.0, 1.0, "High")
    assert out[3].payload_error == "unparsable body" and out[3].current_speed is None and out[3].congestion_level is None
    assert out[0].timestamp == "2024-01-01T08:00:00.000000+00:00"


def test_weather_and_air_payloads_merge_per_poll(spark):
    w = land(spark, [json.dumps({"main": {"temp": 31.0, "feels_like": 33.0, "humidity": 70, "pressure": 1009},
                                 "wind": {"speed": 2.0}, "weather": [{"main": "Rain"}]}),
                     json.dumps({"main": {}, "weather": []})])
    a = land(spark, [json.dumps({"list": [{"main": {"aqi": 4}, "components": {"co": 1.0, "pm2_5": 50.0}}]}),
                     json.dumps({"list": []})])
    out = {r.poll_id: r for r in payloads.merge_weather_air(payloads.flatten_weather(w), payloads.flatten_air(a)).collect()}
    assert (out[0].temperature, out[0].weather_condition, out[0].aqi, out[0].co, out[0].no2, out[0].pm2_5) == (31.0, "Rain", 4, 1.0, 20.0, 50.0)
    assert (out[1].temperature, out[1].humidity, out[1].pressure, out[1].wind_speed, out[1].weather_condition, out[1].aqi, out[1].pm10) == (
        25.0, 50, 1013, 3.5, "Clear", 2, 30.0)


def test_landing_one_object_per_file_and_missing_folder(spark, tmp_path):
    d = tmp_path / "traffic"
    d.mkdir()
    for i in range(3):
        (d / f"A_{i}.json").write_text(json.dumps({"timestamp": f"2024-01-01T08:00:0{i}+00:00", "city_name": "A",
                                                   "current_speed": 30.0 + i, "current_travel_time": 7}, indent=2))
    (d / "notes.txt").write_text("ignored")
    df = landing.read_landing(spark, str(d), schemas.TRAFFIC_SCHEMA)
    assert df.count() == 3 and df.schema == schemas.TRAFFIC_SCHEMA
    empty = landing.read_landing(spark, str(tmp_path / "missing"), schemas.TRAFFIC_SCHEMA)
    assert empty.count() == 0 and empty.schema == schemas.TRAFFIC_SCHEMA


def test_publish_fan_out_and_topic_parse(spark):
    t = spark.createDataFrame([("A", "t1", 30.0)], "city_name string, timestamp string, current_speed double")
    w = spark.createDataFrame([("B", "t2", 20.0)], "city_name string, timestamp string, temperature double")
    frame = writers.publish_frame(t, w, topics={"aqi": "air"})
    assert rows(frame, "topic", "key") == [("air", "B"), ("traffic-raw-events", "A"), ("weather-raw-events", "B")]
    parsed = streams.parse_topic_frame(frame.filter("topic = 'traffic-raw-events'"),
                                       schemas.with_fields(schemas.TRAFFIC_SCHEMA, []))
    assert rows(parsed, "key", "city_name", "current_speed") == [("A", "A", 30.0)]


def test_landing_fallback_and_csv(spark):
    base = scratch_path(spark, "test-io")
    t = spark.createDataFrame([("A", "t1", 30.0), ("B", "t2", 31.0)], "city_name string, timestamp string, current_speed double")
    route = writers.publish(writers.publish_frame(t, None), f"{base}/landing", bootstrap_servers=None)
    assert route == "landing"
    back = landing_zone.read_epochs(spark, f"{base}/landing", "traffic-raw-events", schemas.TRAFFIC_SCHEMA)
    assert rows(back, "city_name", "current_speed") == [("A", 30.0), ("B", 31.0)]
    writers.export_csv(t, f"{base}/csv", single_file=True)
    back = writers.read_csv(spark, f"{base}/csv", "city_name string, timestamp string, current_speed double")
    assert rows(back) == rows(t)


def test_table_overwrite_drops_stale_partitions_partition_refresh_keeps_them(spark):
    base = scratch_path(spark, "test-overwrite")
    a = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "city_name string, v double")
    b = spark.createDataFrame([("B", 3.0)], "city_name string, v double")
    writers.write_layer(a, f"{base}/t")
    writers.write_layer(b, f"{base}/t")
    assert rows(spark.read.parquet(f"{base}/t"), "city_name", "v") == [("B", 3.0)]
    writers.write_layer(a, f"{base}/p")
    writers.write_layer(b, f"{base}/p", replace="partitions")
    assert rows(spark.read.parquet(f"{base}/p"), "city_name", "v") == [("A", 1.0), ("B", 3.0)]
