"""Whole jobs (W1-W6): bronze, silver, gold, training and the full run, file to file.

Counts are taken with ``observe`` while each table is written (T13): no second pass over the
input unless the result is empty, and the logged numbers belong to the rows actually written. Each layer hands over by
files, so a failed stage restarts from the last written table, not from the raw input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.ml import models
from strata.operators import gold, quality, silver
from strata.operators.layers import add_layer_metadata
from strata.sinks import landing_zone, publishing, writers
from strata.sources import landing, topics


@dataclass(frozen=True)
class Layout:
    """Table locations below one root (a shared file system or object-store URI)."""
    root: str
    traffic_topic: str = writers.DEFAULT_TOPICS["traffic"]
    weather_topic: str = writers.DEFAULT_TOPICS["weather"]
    # Folder of one topic below landing/: "topic={topic}" is what the publish fallback (K8)
    # writes; "{topic}" reads one-object-per-file folders named after the topic.
    landing_pattern: str = "topic={topic}"

    @property
    def landing_root(self) -> str:
        return f"{self.root}/landing"

    def landing(self, topic: str) -> str:
        return f"{self.landing_root}/{self.landing_pattern.format(topic=topic)}"

    def bronze(self, topic: str) -> str:
        return f"{self.root}/bronze/{topic}"

    @property
    def silver_traffic(self) -> str:
        return f"{self.root}/silver/traffic"

    @property
    def silver_weather(self) -> str:
        return f"{self.root}/silver/weather"

    @property
    def mart(self) -> str:
        return f"{self.root}/gold/feature_mart"

    @property
    def analytics(self) -> str:
        return f"{self.root}/gold/analytics"

    @property
    def models(self) -> str:
        return f"{self.root}/models"

    @property
    def exports(self) -> str:
        return f"{self.root}/exports"


class Observed:
    """Metrics taken while a frame is written.

    When adaptive execution finds that a frame is empty it may drop the node that observes it,
    and the metrics with it. They are then computed from the frame itself, so that a count is
    never assumed.
    """

    def __init__(self, df: DataFrame, name: str, *metrics):
        metrics = metrics or (F.count(F.lit(1)).alias("rows"),)
        self.source, self.metrics, self.observation = df, metrics, Observation(name)
        self.df = df.observe(self.observation, *self.metrics)

    def get(self) -> dict:
        try:
            return self.observation.get
        except Py4JJavaError as error:
            # an observation that was dropped has a row without fields, which Spark asserts against
            if error.java_exception.getClass().getName() != "java.lang.AssertionError":
                raise
            return self.source.agg(*self.metrics).first().asDict()

    def rows(self) -> int:
        return int(self.get()["rows"] or 0)


def layer_schema(frame: DataFrame):
    """The declared schema of a written layer: that of the transformation on typed empty rows."""
    return frame.schema


def bronze_frame(df: DataFrame, stamp_ingestion: bool = True) -> DataFrame:
    return add_layer_metadata(df, "Bronze", "ingestion_timestamp" if stamp_ingestion else None)


def silver_schemas(spark: SparkSession, traffic=None, weather=None) -> tuple:
    """Declared schemas of the two silver tables, from the event schemas of their feeds."""
    return tuple(layer_schema(silver.silver(bronze_frame(landing.empty(spark, s)), r)) for s, r in (
        (traffic or schemas.TRAFFIC_SCHEMA, quality.traffic_rules()),
        (weather or schemas.WEATHER_SCHEMA, quality.weather_rules())))


def bronze_job(spark: SparkSession, src: str, dst: str, schema, multi_line: bool = True,
               stamp_ingestion: bool = True) -> dict:
    """Landing JSON (declared schema) + P1, written partitioned by location.

    ``stamp_ingestion=False`` keeps an ``ingestion_timestamp`` already present in the events. A landing zone with a
    ledger (``<zone>/topic=<name>`` beside ``<zone>/_ledger``) is read by its epochs.
    """
    zone, _, folder = src.rstrip("/").rpartition("/")
    if folder.startswith("topic=") and not landing_zone.ledger(spark, zone).isEmpty():
        df = landing_zone.read_epochs(spark, zone, folder.removeprefix("topic="), schema)
    else:
        df = landing.read_landing(spark, src, schema, multi_line=multi_line,
                                  glob="*.json" if multi_line else None)
    if df.isEmpty():  # nothing landed: the table of an earlier run stays as it is
        return {"layer": "bronze", "path": dst, "rows": 0, "skipped": True}
    seen = Observed(bronze_frame(df, stamp_ingestion), "bronze")
    writers.write_layer(seen.df, dst)
    return {"layer": "bronze", "path": dst, "rows": seen.rows()}


def silver_job(spark: SparkSession, src: str, dst: str, rules, filter_first: bool = False,
               schema=None) -> dict:
    """Bronze table -> dedup, rules, calendar features -> silver table, with the row
    accounting (D4) observed in the same pass: input rows, duplicates removed, rejects per rule
    (first rule failed) and rows written. ``schema`` declares the bronze table, so that partition
    values keep their types and a table without rows can be read."""
    bronze = (topics.read_bronze(spark, src, schema) if schema is not None and topics.last_batch(spark, src)
              else landing.read_table(spark, src, schema))
    if bronze is None:  # S5: nothing landed yet is not an error
        return {"layer": "silver", "path": dst, "rows_in": 0, "rows": 0, "duplicates": 0,
                "rejects": {}, "skipped": True}
    seen = Observed(bronze, "silver_in")
    if filter_first:
        kept = Observed(silver.silver(seen.df, rules, filter_first=True), "silver_out")
        writers.write_layer(kept.df, dst)
        return {"layer": "silver", "path": dst, "rows_in": seen.rows(), "rows": kept.rows(),
                "removed": seen.rows() - kept.rows()}
    metrics = [F.count(F.lit(1)).alias("survivors")] + [
        F.sum(F.when(F.col("__reject") == r.name, 1).otherwise(0)).alias(f"rule_{i}") for i, r in enumerate(rules)]
    verdicts = Observed(silver.silver(seen.df, rules, reject_col="__reject"), "silver_rules", *metrics)
    writers.write_layer(verdicts.df.filter(F.col("__reject").isNull()).drop("__reject"), dst)
    n_in, v = seen.rows(), verdicts.get()
    rejects = {r.name: int(v.get(f"rule_{i}") or 0) for i, r in enumerate(rules)}
    survivors = int(v.get("survivors") or 0)
    return {"layer": "silver", "path": dst, "rows_in": n_in, "duplicates": n_in - survivors,
            "rejects": {k: n for k, n in rejects.items() if n}, "rows": survivors - sum(rejects.values())}


def gold_job(spark: SparkSession, traffic_path: str, weather_path: str, mart_path: str,
             analytics_path: str, fallback: str = "global", silver_tables=None) -> dict:
    """Feature mart, then the KPI rollup from the written mart (no recomputation).

    With ``fallback="global"`` the hourly-join mart is written first and its row count observed
    on the way; only when it is empty is the location-level fallback computed and written
    instead, so the common case pays nothing for the check. ``silver_tables`` declares the
    schemas of the two silver tables.
    """
    t_schema, w_schema = silver_tables or silver_schemas(spark)
    traffic = landing.read_table(spark, traffic_path, t_schema)
    weather = landing.read_table(spark, weather_path, w_schema)
    if traffic is None or weather is None:  # S5
        return {"layer": "gold", "mart_rows": 0, "analytics_rows": 0, "skipped": True}
    first = "none" if fallback == "global" else fallback
    mart = Observed(gold.feature_mart(traffic, weather, fallback=first), "mart")
    writers.write_layer(mart.df, mart_path)
    if fallback == "global" and mart.rows() == 0:
        hourly = gold.hourly_weather(weather)
        mart = Observed(gold.add_gold_features(gold.location_fallback_join(traffic, hourly)), "mart_fallback")
        writers.write_layer(mart.df, mart_path)
    written = writers.read_layer(spark, mart_path, layer_schema(mart.source))
    kpi = Observed(gold.kpi_rollup(written, order_by=None), "analytics")
    writers.write_layer(kpi.df, analytics_path)
    return {"layer": "gold", "mart_rows": mart.rows(), "analytics_rows": kpi.rows()}


def training_job(spark: SparkSession, analytics_path: str, mart_path: str, model_dir: str,
                 speed_params: dict | None = None, aqi_params: dict | None = None) -> dict:
    """S8 + P14 + P15 + X1-X4 + X6 + K11 (model parameters default to the presets)."""
    df = landing.read_gold_for_training(spark, analytics_path, mart_path)
    speed = models.train_speed(df, **(speed_params or {}))
    aqi = models.train_aqi(df, **(aqi_params or {}))
    models.save(speed.model, f"{model_dir}/speed")
    models.save(aqi.model, f"{model_dir}/aqi")
    return {"speed": speed.metrics, "aqi": aqi.metrics}


def medallion_run(spark: SparkSession, layout: Layout, multi_line: bool = True,
                  stamp_ingestion: bool = True, train: bool = True, export: bool = True,
                  publish_to: str | None = None, model_params: dict | None = None,
                  events: tuple[DataFrame | None, DataFrame | None] | None = None,
                  bootstrap_servers: str | None = None,
                  read_topics: Callable = topics.read_topic_batch) -> list[dict]:
    """(publish) -> landing or topics -> bronze -> silver -> gold (-> layer publish, models, BI export).

    ``events`` = ``(traffic, weather)`` standardized events (e.g. flattened API payloads) are
    first published (K6/K7) to the broker, or to the landing zone when there is none (K8); the
    bronze jobs then read what landed (JSON lines). After a broker publish they read the topics instead, on from
    their stored offsets, with ``read_topics(spark, bootstrap_servers, [topic], starting_offsets)``.
    """
    log, route = [], None
    if events is not None:
        frame = writers.publish_frame(*events)
        route = writers.publish(frame, layout.landing_root, bootstrap_servers)
        log.append({"layer": "publish events", "route": route})
        multi_line = False
    stamps = [] if stamp_ingestion else [
        ("event_id", schemas.L), ("ingestion_timestamp", schemas.T.TimestampNTZType())]
    feeds = [(layout.traffic_topic, schemas.with_fields(schemas.TRAFFIC_SCHEMA, stamps),
              layout.silver_traffic, quality.traffic_rules()),
             (layout.weather_topic, schemas.with_fields(schemas.WEATHER_SCHEMA, stamps),
              layout.silver_weather, quality.weather_rules())]
    bronze = [bronze_frame(landing.empty(spark, f[1]), stamp_ingestion) for f in feeds]
    tables = [layer_schema(silver.silver(b, f[3])) for b, f in zip(bronze, feeds)]
    for topic, schema, _, _ in feeds:
        path = layout.bronze(topic)
        if route == landing_zone.TOPICS:
            records = read_topics(spark, bootstrap_servers, [topic], topics.starting_offsets(spark, path))
            if "headers" in records.columns:
                records = landing_zone.only_routed(records, spark, layout.landing_root)
            log.append(topics.append_bronze(spark, records, path, schema, stamp_ingestion))
        else:
            log.append(bronze_job(spark, layout.landing(topic), path, schema, multi_line=multi_line,
                                  stamp_ingestion=stamp_ingestion))
    log += [silver_job(spark, layout.bronze(topic), dst, rules, schema=layer_schema(b))
            for (topic, _, dst, rules), b in zip(feeds, bronze)]
    log.append(gold_job(spark, layout.silver_traffic, layout.silver_weather, layout.mart,
                        layout.analytics, silver_tables=tables))
    if publish_to:
        bronze_layers = [(f"bronze/{f[0]}", layout.bronze(f[0])) for f in feeds]
        for name, path in (*bronze_layers, ("silver/traffic", layout.silver_traffic),
                           ("silver/weather", layout.silver_weather), ("gold/feature_mart", layout.mart),
                           ("gold/analytics", layout.analytics)):
            summary = publishing.publish_layer(spark, path, f"{publish_to}/{name}", layer=name).first()
            log.append({**summary.asDict(), "layer": f"publish {name}"})
    if train:
        mp = model_params or {}
        log.append({"layer": "models", **training_job(spark, layout.analytics, layout.mart, layout.models,
                                                       mp.get("speed"), mp.get("aqi"))})
    if export:
        mart_schema = layer_schema(gold.feature_mart(*(landing.empty(spark, t) for t in tables), fallback="none"))
        for name, path, schema in (("gold_feature_mart", layout.mart, mart_schema),
                                   ("gold_analytics", layout.analytics, schemas.ANALYTICS_SCHEMA)):
            t = landing.read_table(spark, path, schema)
            if t is not None:  # the analytics table is small: one file, as the dashboards read it
                writers.export_csv(t, f"{layout.exports}/{name}", single_file=name == "gold_analytics")
        log.append({"layer": "export", "path": layout.exports})
    return log
