"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``events`` / ``region`` tables (through the fixture feeds of ``strata.sources.fixtures``).

Output columns leave out processing-time stamps (``current_timestamp``) and the
session-zone ``event_timestamp``; everything else is the operator's own output.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.metrics import predicted_congestion_index
from strata.functions.rounding import round_half_up
from strata.ml import ensembles, evaluation, models
from strata.operators import decisions, gold, locations, measures, quality, silver, skew
from strata.operators.layers import add_layer_metadata, add_temporal_features
from strata.plans import medallion
from strata.session import checkpoint_root, scratch_path
from strata.sinks import landing_zone, publishing, writers
from strata.sources import fixtures, landing, payloads, topics
from strata.streaming import streams

TRAFFIC_COLS = ["event_id", "timestamp", "city_name", "latitude", "longitude", "current_speed",
                "free_flow_speed", "current_travel_time", "free_flow_travel_time", "congestion_ratio",
                "congestion_level", "confidence", "road_closure", "data_source", "ingestion_timestamp"]
WEATHER_COLS = ["event_id", "timestamp", "city_name", "latitude", "longitude", "temperature",
                "feels_like", "humidity", "pressure", "wind_speed", "weather_condition", "aqi", "co",
                "no2", "o3", "so2", "pm2_5", "pm10", "data_source", "ingestion_timestamp"]
CAL_COLS = ["hour", "day_of_week", "day_of_month", "month", "year", "is_weekend"]
SILVER_TRAFFIC_COLS = TRAFFIC_COLS + CAL_COLS + ["data_layer"]
SILVER_WEATHER_COLS = WEATHER_COLS + CAL_COLS + ["data_layer"]
HOURLY_COLS = ["w_city", "w_year", "w_month", "w_day", "w_hour", *gold.WEATHER_MEASURES]
JOIN_COLS = ["event_id", "timestamp", "city_name", "year", "month", "day_of_month", "hour",
             "is_weekend", "current_speed", "free_flow_speed", "congestion_level",
             *gold.WEATHER_MEASURES]
MART_COLS = SILVER_TRAFFIC_COLS[:-1] + list(gold.WEATHER_MEASURES) + [
    "weather_severity_index", "speed_ratio", "delay_time_seconds", "data_layer"]
KPI_COLS = ["city_name", "hour", "is_weekend", "congestion_level",
            *[name for name, _, _ in gold.KPI_AVERAGES], "total_observations"]


def _silver_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_traffic(fixtures.traffic_raw(spark, sf))


def _silver_weather(spark: SparkSession, sf: str, year_shift: int = 0) -> DataFrame:
    return silver.silver_weather(fixtures.weather_raw(spark, sf, year_shift=year_shift))


def parse_temporal(spark: SparkSession, sf: str) -> DataFrame:
    """P2-P4 over the weather feed."""
    df = add_temporal_features(fixtures.weather_raw(spark, sf))
    return df.select("event_id", "timestamp", "city_name", *CAL_COLS)


def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    """D1 over the traffic feed (earliest ingestion survives)."""
    df = quality.dedup(fixtures.traffic_raw(spark, sf), silver.EVENT_KEYS, silver.FIRST_INGESTED)
    return df.select("event_id", "city_name", "timestamp", "current_speed", "ingestion_timestamp")


def quality_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """F1 + F2 over the raw traffic feed."""
    return quality.apply_rules(fixtures.traffic_raw(spark, sf), quality.traffic_rules()).select(*TRAFFIC_COLS)


def quality_weather(spark: SparkSession, sf: str) -> DataFrame:
    """F3 + F4 over the raw weather feed."""
    return quality.apply_rules(fixtures.weather_raw(spark, sf), quality.weather_rules()).select(*WEATHER_COLS)


def row_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """D4 for both feeds."""
    t = quality.row_accounting(fixtures.traffic_raw(spark, sf), silver.EVENT_KEYS, silver.FIRST_INGESTED,
                               quality.traffic_rules(), "traffic")
    w = quality.row_accounting(fixtures.weather_raw(spark, sf), silver.EVENT_KEYS, silver.FIRST_INGESTED,
                               quality.weather_rules(), "weather")
    return t.unionByName(w)


def silver_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_traffic(spark, sf).select(*SILVER_TRAFFIC_COLS)


def silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_weather(spark, sf).select(*SILVER_WEATHER_COLS)


def hourly_weather(spark: SparkSession, sf: str) -> DataFrame:
    return gold.hourly_weather(_silver_weather(spark, sf)).select(*HOURLY_COLS)


def hourly_join(spark: SparkSession, sf: str) -> DataFrame:
    hourly = gold.hourly_weather(_silver_weather(spark, sf))
    return gold.hourly_join(_silver_traffic(spark, sf), hourly).select(*JOIN_COLS)


def hourly_join_hot(spark: SparkSession, sf: str) -> DataFrame:
    """J1 with a hot location-hour: the timestamps of one location move into one hour, which then holds most of its rows; the
    measured hot hour is salted."""
    stored = scratch_path(spark, "hot-hour")
    traffic = _silver_traffic(spark, sf)
    hot = (F.col("city_name") == "ASIA") & (F.col("day_of_month") <= 20)
    writers.write_layer(traffic.withColumns({
        "day_of_month": F.when(hot, F.lit(3)).otherwise(F.col("day_of_month")),
        "month": F.when(hot, F.lit(1)).otherwise(F.col("month")),
        "hour": F.when(hot, F.lit(5)).otherwise(F.col("hour"))}), stored)
    weather = gold.hourly_weather(_silver_weather(spark, sf))
    silver_schema = medallion.layer_schema(traffic)
    joined = gold.hourly_join(writers.read_layer(spark, stored, silver_schema), weather, hot_share=0.01)
    return joined.select(*JOIN_COLS)


def fallback_join(spark: SparkSession, sf: str) -> DataFrame:
    """D3 + J2: weather shifted one year, so the hourly join is empty and the location-level
    fallback runs."""
    hourly = gold.hourly_weather(_silver_weather(spark, sf, year_shift=1))
    return gold.join_weather(_silver_traffic(spark, sf), hourly, fallback="global").select(*JOIN_COLS)


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return gold.feature_mart(_silver_traffic(spark, sf), _silver_weather(spark, sf))


def feature_mart(spark: SparkSession, sf: str) -> DataFrame:
    return _mart(spark, sf).select(*MART_COLS)


def kpi_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return gold.kpi_rollup(_mart(spark, sf)).select(*KPI_COLS)


def kpi_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """O1: the KPI table in its order (location, hour, then the other keys), with each row's position in it.

    Positions come from the sorted rows of each location and the row counts of the locations before it."""
    kpi = gold.kpi_rollup(_mart(spark, sf), order_by=None)
    before = Window.orderBy("city_name").rowsBetween(Window.unboundedPreceding, -1)
    counts = (kpi.groupBy("city_name").agg(F.count(F.lit(1)).alias("n"))  # one row per location
              .select("city_name", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    within = F.row_number().over(Window.partitionBy("city_name").orderBy(*gold.KPI_KEYS[1:]))
    return (kpi.withColumn("within", within).join(counts, "city_name")
            .select(*gold.KPI_KEYS, "total_observations", (F.col("before") + F.col("within")).alias("position")))


MEASURE_COLS = ["avg_congestion_ratio", "avg_current_speed", "avg_free_flow_speed", "congestion_index_pct",
                "peak_hour_congestion", "average_aqi", "average_pm2_5", "weather_risk_level"]
# Measures are means of means in double arithmetic; six decimals make them engine independent.
MEASURE_DIGITS = 6


def measures_by_location(spark: SparkSession, sf: str) -> DataFrame:
    """M1-M8 (F6 inside M5) per location over the KPI table."""
    kpi = gold.kpi_rollup(_mart(spark, sf), order_by=None)
    return measures.measures(kpi, by=["city_name"], digits=MEASURE_DIGITS).select("city_name", *MEASURE_COLS)


def measures_total(spark: SparkSession, sf: str) -> DataFrame:
    """M1-M8 grand total."""
    kpi = gold.kpi_rollup(_mart(spark, sf), order_by=None)
    return measures.measures(kpi, by=[], digits=MEASURE_DIGITS).select(*MEASURE_COLS)


def measures_by_location_hour(spark: SparkSession, sf: str) -> DataFrame:
    """M1-M8 per location and clock hour; the peak measure ignores the hour slice (M5)."""
    kpi = gold.kpi_rollup(_mart(spark, sf), order_by=None)
    return measures.measures(kpi, by=["city_name", "hour"], digits=MEASURE_DIGITS).select(
        "city_name", "hour", *MEASURE_COLS)


def region_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Location dimension of the fixture: one row per region, names in lower case."""
    r = fixtures.table(spark, sf, "region")
    return r.select(
        F.lower("r_name").alias("name"),
        F.lit("region").alias("area_type"),
        (F.lit(19.0) + F.col("r_regionkey") * F.lit(0.25)).alias("lat"),
        (F.lit(72.75) + F.col("r_regionkey") * F.lit(0.125)).alias("lon"),
        (F.lit(12) + F.col("r_regionkey") % 3).cast("int").alias("zoom"),
    )


def location_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """S9 + J4: silver traffic with area, coordinates and zoom (case-insensitive match)."""
    out = locations.enrich_locations(_silver_traffic(spark, sf), region_locations(spark, sf))
    return out.select("event_id", "city_name", "location_name", "area_type", "lat", "lon", "zoom")


def location_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """location names of both raw feeds that a dimension without one of the regions lacks."""
    names = (fixtures.traffic_raw(spark, sf).select("city_name")
             .unionByName(fixtures.weather_raw(spark, sf).select("city_name")))
    known = region_locations(spark, sf).where("name <> 'asia'")
    return locations.unknown_locations(names, known).select(
        F.col("name_seen").alias("city_name"), "events")


def scored_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Mart rows with the location-hour averages standing in for model predictions."""
    mart = _mart(spark, sf)
    pred = mart.groupBy("city_name", "hour").agg(
        round_half_up(F.avg("current_speed"), 1).alias("predicted_speed"),
        round_half_up(F.avg("aqi"), 1).alias("predicted_aqi"),
    )
    return skew.join_aggregate(mart, pred, ["city_name", "hour"])


def decision_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """R1-R8 over every mart row."""
    out = decisions.recommend(scored_mart(spark, sf))
    return out.select(
        "event_id", "city_name", "hour", "predicted_speed", "predicted_aqi", "speed_drop_percent",
        "primary_alert",
        F.array_join("alerts", " | ").alias("alerts_text"),
        F.array_join("recommendations", " | ").alias("recommendations_text"),
        "recommended_travel_window",
        F.size("alerts").alias("n_alerts"),
    )


QUERIES = {
    "parse_temporal": parse_temporal,
    "dedup_events": dedup_events,
    "quality_traffic": quality_traffic,
    "quality_weather": quality_weather,
    "row_accounting": row_accounting,
    "silver_traffic": silver_traffic,
    "silver_weather": silver_weather,
    "hourly_weather": hourly_weather,
    "hourly_join": hourly_join,
    "hourly_join_hot": hourly_join_hot,
    "fallback_join": fallback_join,
    "feature_mart": feature_mart,
    "kpi_rollup": kpi_rollup,
    "kpi_ordered": kpi_ordered,
    "measures_by_location": measures_by_location,
    "measures_total": measures_total,
    "measures_by_location_hour": measures_by_location_hour,
    "location_enrich": location_enrich,
    "location_unknown": location_unknown,
    "decision_alerts": decision_alerts,
}


# --- raw payloads, bronze, publishing, sinks ----------------------------------------------------

FLAT_TRAFFIC_COLS = ["poll_id", "timestamp", "city_name", "latitude", "longitude", "current_speed",
                     "free_flow_speed", "current_travel_time", "free_flow_travel_time", "congestion_ratio",
                     "congestion_level", "confidence", "road_closure", "data_source", "payload_error"]
FLAT_WEATHER_COLS = ["poll_id", "timestamp", "city_name", "latitude", "longitude", "temperature",
                     "feels_like", "humidity", "pressure", "wind_speed", "weather_condition", "aqi", "co",
                     "no2", "o3", "so2", "pm2_5", "pm10", "data_source", "payload_error"]


def _flat_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.flatten_traffic(fixtures.raw_traffic_landing(spark, sf))


def _flat_weather(spark: SparkSession, sf: str) -> DataFrame:
    w = payloads.flatten_weather(fixtures.raw_weather_landing(spark, sf))
    a = payloads.flatten_air(fixtures.raw_air_landing(spark, sf))
    return payloads.merge_weather_air(w, a)


def flatten_raw_traffic(spark: SparkSession, sf: str) -> DataFrame:
    """S11 + P11 + P12 over raw traffic response bodies."""
    return _flat_traffic(spark, sf).select(*FLAT_TRAFFIC_COLS)


def flatten_raw_weather_aqi(spark: SparkSession, sf: str) -> DataFrame:
    """S12 + S13 + J3 over raw weather and air-quality bodies."""
    return _flat_weather(spark, sf).select(*FLAT_WEATHER_COLS)


def bronze_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """P1 (bronze): layer name and ingestion stamp on the flattened traffic events."""
    df = add_layer_metadata(_flat_traffic(spark, sf), "Bronze", "ingestion_timestamp")
    return df.select(*FLAT_TRAFFIC_COLS, "data_layer")


def publish_events(spark: SparkSession, sf: str) -> DataFrame:
    """K6 + K7: topic fan-out of both feeds, the JSON value parsed back to columns."""
    frame = writers.publish_frame(_flat_traffic(spark, sf), _flat_weather(spark, sf))
    parsed = F.from_json("value", "poll_id long, timestamp string, city_name string")
    return frame.select("topic", "key", parsed["poll_id"].alias("poll_id"),
                        parsed["timestamp"].alias("timestamp"))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K5: the KPI table exported as CSV and read back with its declared schema."""
    path = scratch_path(spark, "bi-export")
    writers.export_csv(kpi_rollup(spark, sf).select(*schemas.ANALYTICS_SCHEMA.names), path)
    return writers.read_csv(spark, path, schemas.ANALYTICS_SCHEMA).select(*KPI_COLS)


def landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K8 + S1: traffic events published to the landing fallback in two epochs, each tried twice, and read back."""
    path = scratch_path(spark, "landing")
    events = _flat_traffic(spark, sf)
    for epoch in (0, 1, 1, 0):  # a replayed epoch lands once
        part = events.where(F.pmod("poll_id", F.lit(2)) == epoch)
        writers.publish(writers.publish_frame(part, None), path, epoch=f"run-{epoch}")
    schema = schemas.with_fields(schemas.TRAFFIC_SCHEMA, [("poll_id", schemas.L), ("payload_error", schemas.S)])
    df = landing_zone.read_epochs(spark, path, writers.DEFAULT_TOPICS["traffic"], schema)
    return df.select(*FLAT_TRAFFIC_COLS)


def topic_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 + W5: published traffic events as topic records ``(topic, partition, offset, key, value)``, appended to bronze in
    two overlapping reads with the stored offsets between them."""
    bronze = scratch_path(spark, "topic-bronze")
    sent = (writers.publish_frame(_flat_traffic(spark, sf), None)
            .withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(3)).cast("int")))
    records = topics.with_offsets(sent, F.get_json_object("value", "$.poll_id").cast("long"))
    schema = schemas.with_fields(schemas.TRAFFIC_SCHEMA, [("poll_id", schemas.L), ("payload_error", schemas.S)])
    for cut in (records.where("offset < 100 or partition = 0"), records):
        topics.append_bronze(spark, cut, bronze, schema)
    return topics.read_bronze(spark, bronze, schema).select(*FLAT_TRAFFIC_COLS)


def layer_publish(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + K9: publish the silver traffic layer three times: whole, unchanged, and with one location's partition
    written anew. One row per publish: whether all, none or some of the files were written, and the rows of the copy."""
    src, dst = scratch_path(spark, "silver-traffic"), scratch_path(spark, "published")
    layer = _silver_traffic(spark, sf)
    writers.write_layer(layer, src)
    out = None
    for step in range(1, 4):
        if step == 3:
            writers.write_layer(layer.where("city_name = 'ASIA' and hour < 12"), src, replace="partitions")
        summary = publishing.publish_layer(spark, src, dst, layer="silver/traffic")
        rows = publishing.read_as_text(spark, dst).agg(F.count(F.lit(1)).alias("rows")).first().rows
        sent = (F.when(F.col("uploaded_files") == 0, "none")
                .when(F.col("uploaded_files") == F.col("total_files"), "all").otherwise("some"))
        row = summary.select("layer", F.lit(step).alias("publish"), sent.alias("uploaded"),
                             (F.col("uploaded_files") + F.col("skipped_files") == F.col("total_files")).alias("adds_up"),
                             F.lit(rows).cast("long").alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


def layer_publish_rows(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + K9: the published copy of the silver weather layer, counted per location partition."""
    src, dst = scratch_path(spark, "silver-weather"), scratch_path(spark, "published-weather")
    writers.write_layer(_silver_weather(spark, sf), src)
    publishing.publish_layer(spark, src, dst, layer="silver/weather")
    return publishing.read_as_text(spark, dst).groupBy("city_name").agg(F.count(F.lit(1)).alias("rows"))


def object_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The file manifest of a freshly written layer against the rows each file holds, per partition folder."""
    path = scratch_path(spark, "manifest")
    writers.write_layer(_silver_weather(spark, sf), path)
    files = publishing.object_manifest(spark, path)
    held = (publishing.read_as_text(spark, path)
            .groupBy(F.col("city_name").alias("partition"), F.col("_metadata.file_name").alias("name"))
            .agg(F.count(F.lit(1)).alias("n")))
    listed = files.select(F.regexp_extract("relative", r"city_name=([^/]+)/", 1).alias("partition"),
                          F.regexp_extract("relative", "[^/]*$", 0).alias("name"), "length")
    return listed.join(held, ["partition", "name"], "full").groupBy("partition").agg(
        F.sum("n").alias("rows"), F.count_if(F.col("n").isNull() | (F.col("length") <= 0)).alias("wrong_files"))


QUERIES.update({
    "flatten_raw_traffic": flatten_raw_traffic,
    "flatten_raw_weather_aqi": flatten_raw_weather_aqi,
    "bronze_metadata": bronze_metadata,
    "publish_events": publish_events,
    "csv_roundtrip": csv_roundtrip,
    "landing_roundtrip": landing_roundtrip,
    "topic_bronze": topic_bronze,
    "layer_publish": layer_publish,
    "layer_publish_rows": layer_publish_rows,
    "object_manifest": object_manifest,
})


# --- streaming ------------------------------------------------------------------------------------

LANDING_TRAFFIC_SCHEMA = schemas.with_fields(
    schemas.TRAFFIC_SCHEMA, [("event_id", schemas.L), ("ingestion_timestamp", schemas.T.TimestampNTZType())])


LANDING_WEATHER_SCHEMA = schemas.with_fields(
    schemas.WEATHER_SCHEMA, [("event_id", schemas.L), ("ingestion_timestamp", schemas.T.TimestampNTZType())])


def _stream_round(spark: SparkSession, base: str, kind: str, events: DataFrame, schema, rules) -> streams.DayTables:
    """Land events as two files in hashed (not time) order and stream them into silver one file a micro-batch."""
    land = f"{base}/landing/{kind}"
    landing.write_landing_json(events.select(*schema.names).repartition(2, "event_id"), land)
    tables = streams.silver_tables(spark, f"{base}/silver/{kind}", schema)
    stream = streams.landing_stream(spark, land, schema, max_files_per_trigger=1)
    streams.run_silver_refresh(stream, rules, tables, f"{base}/checkpoint/{kind}")
    return tables


def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    """ST2-ST5: landing stream, merge by touched days, rules, calendar features.

    The originals and the late copies land as several files in hashed (not time) order and are
    read one file a micro-batch, so most rows come behind the newest event seen; none is lost.
    """
    base = scratch_path(spark, "silver-stream")
    for generation in (0, 1):
        tables = _stream_round(spark, base, "traffic", fixtures.traffic_raw(spark, sf, generation=generation),
                               LANDING_TRAFFIC_SCHEMA, quality.traffic_rules())
    return tables.read("silver").select(*SILVER_TRAFFIC_COLS)


def _weather_generations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The weather feed split at the middle of its time range (earlier half, later half); the
    midpoint is an uncorrelated scalar subquery, computed once."""
    w = fixtures.weather_raw(spark, sf)
    t0, t1 = F.col("t0").cast("timestamp"), F.col("t1").cast("timestamp")
    mid = (w.agg(F.min("ingestion_timestamp").alias("t0"), F.max("ingestion_timestamp").alias("t1"))
            .select(F.timestamp_add("SECOND", (F.unix_timestamp(t1) - F.unix_timestamp(t0)) / 2, F.col("t0")))
            .scalar())
    return w.filter(F.col("ingestion_timestamp") < mid), w.filter(F.col("ingestion_timestamp") >= mid)


def stream_gold_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """ST2-ST6: both feeds land in three rounds and stream through silver, one file in hashed order a
    micro-batch; after each round the ``foreachBatch`` gold refresh rebuilds the touched days.

    Round one lands weather alone (its earlier half), so nothing matches. Round two lands all traffic: days
    of the later half get no hourly matches yet. Round three lands the late traffic copies and the later
    weather, which re-triggers exactly those days. The final KPI table equals the batch rollup.
    """
    base = scratch_path(spark, "gold-refresh")
    _stream_gold_rounds(spark, sf, base)
    return writers.read_layer(spark, f"{base}/gold/analytics", schemas.ANALYTICS_SCHEMA).select(*KPI_COLS)


def _stream_gold_rounds(spark: SparkSession, sf: str, base: str, after_round=None) -> None:
    early, late = _weather_generations(spark, sf)
    nothing = fixtures.traffic_raw(spark, sf).limit(0)
    rounds = [(nothing, early), (fixtures.traffic_raw(spark, sf, generation=0), early.limit(0)),
              (fixtures.traffic_raw(spark, sf, generation=1), late)]
    for traffic, weather in rounds:
        t = _stream_round(spark, base, "traffic", traffic, LANDING_TRAFFIC_SCHEMA, quality.traffic_rules())
        w = _stream_round(spark, base, "weather", weather, LANDING_WEATHER_SCHEMA, quality.weather_rules())
        streams.run_gold_refresh(t, w, streams.gold_tables(t, w, f"{base}/gold/tables"), f"{base}/gold/analytics",
                                 f"{base}/checkpoint/gold")
        if after_round:
            after_round(f"{base}/gold/analytics")


QUERIES.update({
    "stream_silver": stream_silver,
    "stream_gold_refresh": stream_gold_refresh,
})


# --- models ---------------------------------------------------------------------------------------

def _kpi(spark: SparkSession, sf: str) -> DataFrame:
    return gold.kpi_rollup(_mart(spark, sf), order_by=None)


def _trained(spark: SparkSession, sf: str, which: str) -> models.Trained:
    return models.train_speed(_kpi(spark, sf)) if which == "speed" else models.train_aqi(_kpi(spark, sf))


def feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    """P14 + P15 + X1: the speed model's features and label per KPI row."""
    return models.feature_rows(_kpi(spark, sf)).select(
        "city_name", "is_weekend", "congestion_level", *models.SPEED_FEATURES, "avg_pressure", "avg_wind_speed")


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Which set each KPI row falls in."""
    train, test = models.split(_kpi(spark, sf))
    return (train.select(*gold.KPI_KEYS, F.lit("train").alias("part"))
            .unionByName(test.select(*gold.KPI_KEYS, F.lit("test").alias("part"))))


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    """The speed features of all KPI rows, scaled by the training rows' mean and deviation."""
    rows = models.feature_rows(_kpi(spark, sf)).withColumn("clock_hour", F.col("hour"))
    scaled = evaluation.scale(rows, models.SPEED_FEATURES, evaluation.scaler(models.split(rows)[0], models.SPEED_FEATURES))
    return scaled.select("city_name", "clock_hour", "is_weekend", "congestion_level",
                         *[round_half_up(F.col(c), 6).alias(f"scaled_{c}") for c in models.SPEED_FEATURES])


def congestion_index(spark: SparkSession, sf: str) -> DataFrame:
    """P16 + P17: the derived index of the stand-in predictions, per mart row."""
    return scored_mart(spark, sf).select(
        "event_id", "predicted_speed", "predicted_aqi",
        predicted_congestion_index("predicted_speed", "free_flow_speed").alias("derived_congestion_index"))


def metrics_check(spark: SparkSession, sf: str) -> DataFrame:
    """X6 for both stand-in predictions over all mart rows, in one pass."""
    pairs = F.explode(F.array(
        F.struct(F.lit("speed").alias("model"), F.col("current_speed").cast("double").alias("label"),
                 F.col("predicted_speed").alias("prediction")),
        F.struct(F.lit("aqi").alias("model"), F.col("aqi").cast("double").alias("label"),
                 F.col("predicted_aqi").alias("prediction"))))
    return evaluation.regression_metrics(scored_mart(spark, sf).select(pairs.alias("p")).select("p.*"))


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """W6 + S8: the training job over a written analytics table; the rows of each set, as the job reports them."""
    layout = medallion.Layout(scratch_path(spark, "training"))
    writers.write_layer(_kpi(spark, sf), layout.analytics)
    done = medallion.training_job(spark, layout.analytics, layout.mart, layout.models,
                                  {"num_trees": 5, "max_depth": 4}, {"max_iter": 3, "max_depth": 3})
    return spark.createDataFrame([(k, m["train_rows"], m["test_rows"]) for k, m in done.items()],
                                 "model string, train_rows long, test_rows long")


def train_speed(spark: SparkSession, sf: str) -> DataFrame:
    """X1-X4a + X6: random-forest speed model on the KPI table; its metrics."""
    return models.metrics_frame(spark, {"speed_random_forest": _trained(spark, sf, "speed")})


def train_aqi(spark: SparkSession, sf: str) -> DataFrame:
    """X1-X3 + X4b + X6: boosted-tree AQI model on the KPI table; its metrics."""
    return models.metrics_frame(spark, {"aqi_boosted_trees": _trained(spark, sf, "aqi")})


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return models.score(_mart(spark, sf), *(_trained(spark, sf, which).model for which in ("speed", "aqi")))


def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """X5 + P16 + P17: both models over every mart row."""
    return _scored(spark, sf).select("event_id", "city_name", "hour", "current_speed", "predicted_speed",
                                     "predicted_aqi", "derived_congestion_index")


def scored_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """R1-R8 over model predictions (the reference's intended use of the rule engine)."""
    out = decisions.recommend(_scored(spark, sf))
    return out.select("event_id", "city_name", "hour", "predicted_speed", "predicted_aqi", "primary_alert",
                      F.array_join("alerts", " | ").alias("alerts_text"), "recommended_travel_window")


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Save the speed pipeline and load it; how many KPI rows it scores differently from the one in memory."""
    path, trained = scratch_path(spark, "model-speed"), _trained(spark, sf, "speed")
    models.save(trained.model, path)
    rows = models.feature_rows(_kpi(spark, sf))
    both = models.load(path).transform(trained.model.transform(rows).select(
        *rows.columns, F.col("speed_prediction").alias("before")))
    return both.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(~F.col("before").eqNullSafe(F.col("speed_prediction"))).alias("differing"))


def node_table_scores(spark: SparkSession, sf: str) -> DataFrame:
    """X4a + X4b + X5: both ensembles written out as node tables and scored as column expressions over every mart
    row; how many rows differ from the fitted pipelines."""
    checkpoint_root(spark)
    kpi = _kpi(spark, sf).checkpoint()  # small; both fits read it, so the mart is not built for each
    speed, aqi = models.train_speed(kpi, num_trees=20).model, models.train_aqi(kpi, max_iter=20).model
    nodes = tuple(ensembles.node_table(m, scratch_path(spark, "nodes"), spark) for m in (speed, aqi))
    outputs = ("predicted_speed", "predicted_aqi", "derived_congestion_index")
    rows = models.score(_mart(spark, sf), speed, aqi)
    rows = models.score(rows.withColumns({f"by_{c}": F.col(c) for c in outputs}), speed, aqi, nodes=nodes)
    return rows.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(~F.col(c).eqNullSafe(F.col(f"by_{c}"))).alias(f"differing_{c}") for c in outputs])


QUERIES.update({
    "train_speed": train_speed,
    "train_aqi": train_aqi,
    "score_batch": score_batch,
    "scored_decisions": scored_decisions,
    "model_roundtrip": model_roundtrip,
    "feature_rows": feature_rows,
    "split_rows": split_rows,
    "scaled_features": scaled_features,
    "congestion_index": congestion_index,
    "metrics_check": metrics_check,
    "training_rows": training_rows,
    "node_table_scores": node_table_scores,
})


# --- whole jobs ------------------------------------------------------------------------------------


def medallion_files(spark: SparkSession, sf: str) -> DataFrame:
    """W1-W4 file to file: both feeds landed as JSON, then bronze, silver and gold jobs; the
    gold analytics table read back equals the KPI rollup."""
    layout = medallion.Layout(scratch_path(spark, "medallion"))
    landing.write_landing_json(fixtures.traffic_raw(spark, sf), layout.landing(layout.traffic_topic))
    landing.write_landing_json(fixtures.weather_raw(spark, sf), layout.landing(layout.weather_topic))
    medallion.medallion_run(spark, layout, multi_line=False, stamp_ingestion=False, train=False, export=False)
    return writers.read_layer(spark, layout.analytics, schemas.ANALYTICS_SCHEMA).select(*KPI_COLS)


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A4 + W1-W4: the row counts that the jobs observe while they write each layer table."""
    layout = medallion.Layout(scratch_path(spark, "medallion-counts"))
    landing.write_landing_json(fixtures.traffic_raw(spark, sf), layout.landing(layout.traffic_topic))
    landing.write_landing_json(fixtures.weather_raw(spark, sf), layout.landing(layout.weather_topic))
    log = medallion.medallion_run(spark, layout, multi_line=False, stamp_ingestion=False, train=False, export=False)
    counts = [(entry["path"].removeprefix(f"{layout.root}/"), entry["rows"]) for entry in log if "path" in entry]
    counts += [(f"gold/{t}", log[-1][f"{n}_rows"]) for t, n in (("feature_mart", "mart"), ("analytics", "analytics"))]
    return spark.createDataFrame(counts, "table string, rows long")


def medallion_from_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """S11-S13 + J3, K6-K8, W1-W4: raw API bodies flattened, published (no broker here, so to
    the landing fallback), then bronze, silver and gold from what landed; returns the KPI table."""
    layout = medallion.Layout(scratch_path(spark, "medallion-payloads"))
    medallion.medallion_run(spark, layout, events=(_flat_traffic(spark, sf), _flat_weather(spark, sf)),
                            train=False, export=False)
    return writers.read_layer(spark, layout.analytics, schemas.ANALYTICS_SCHEMA).select(*KPI_COLS)


def medallion_rerun_without_landing(spark: SparkSession, sf: str) -> DataFrame:
    """A second run that finds no landing folder leaves every layer as it is."""
    layout = medallion.Layout(scratch_path(spark, "medallion-rerun"))
    landing.write_landing_json(fixtures.traffic_raw(spark, sf), layout.landing(layout.traffic_topic))
    landing.write_landing_json(fixtures.weather_raw(spark, sf), layout.landing(layout.weather_topic))
    for pattern in (layout.landing_pattern, "nothing={topic}"):
        medallion.medallion_run(spark, dataclasses.replace(layout, landing_pattern=pattern), multi_line=False,
                                stamp_ingestion=False, train=False, export=False)
    return writers.read_layer(spark, layout.analytics, schemas.ANALYTICS_SCHEMA).select(*KPI_COLS)


QUERIES["medallion_files"] = medallion_files
QUERIES["medallion_rerun_without_landing"] = medallion_rerun_without_landing
QUERIES["medallion_from_payloads"] = medallion_from_payloads
QUERIES["table_counts"] = table_counts
