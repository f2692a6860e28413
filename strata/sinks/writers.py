"""Sinks K1-K8. The landing zone is in ``landing_zone``, layer publish and manifests (K9, K10) in ``publishing``,
model save and load (K11) in ``strata.ml``."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks import landing_zone

# Topic names are parameters (T12); these are the producer's defaults.
DEFAULT_TOPICS = {"traffic": "traffic-raw-events", "weather": "weather-raw-events", "aqi": "aqi-raw-events"}


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ("city_name",),
                mode: str = "overwrite", fmt: str = "parquet", rebalance: bool = True,
                replace: str = "table") -> None:
    """K1-K4: a partitioned table.

    ``replace="table"`` (the reference's behaviour) swaps the whole table on overwrite;
    ``"partitions"`` replaces only the partitions present in ``df`` (incremental refreshes). The
    choice is a write option, so it does not depend on the session's configuration.
    ``rebalance`` asks adaptive execution for evenly sized output tasks by the partition
    columns: a busy location is split over several tasks (and files) instead of one, and a
    quiet one is not spread over every task.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    w.save(path)


def read_layer(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A layer table; with a schema, partition values keep the declared types."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", python_booleans: bool = False) -> None:
    """K5: BI export with a header row. ``single_file`` (one task) is for small tables only.
    ``python_booleans`` writes ``True``/``False`` as the pandas export of the original did."""
    if python_booleans:
        df = df.select(*[F.initcap(F.col(f.name).cast("string")).alias(f.name)
                         if f.dataType.typeName() == "boolean" else F.col(f.name) for f in df.schema.fields])
    if single_file:
        df = df.coalesce(1)
    (df.write.mode("overwrite").option("header", True)
       .option("timestampFormat", timestamp_format).csv(path))


def read_csv(spark: SparkSession, path: str, schema,
             timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> DataFrame:
    return (spark.read.schema(schema).option("header", True)
            .option("timestampFormat", timestamp_format).csv(path))


def publish_frame(traffic: DataFrame | None, weather: DataFrame | None,
                  topics: dict | None = None, key_col: str = "city_name") -> DataFrame:
    """K6 + K7: ``(topic, key, value)`` rows, value = the event as JSON.

    A traffic event goes to the traffic topic; a weather event goes to both the weather and
    the air-quality topics (T11).
    """
    t = {**DEFAULT_TOPICS, **(topics or {})}
    parts = []
    if traffic is not None:
        parts.append(traffic.select(F.lit(t["traffic"]).alias("topic"), F.col(key_col).alias("key"),
                                    F.to_json(F.struct(*traffic.columns)).alias("value")))
    if weather is not None:
        parts.append(weather.select(F.explode(F.array(F.lit(t["weather"]), F.lit(t["aqi"]))).alias("topic"),
                                    F.col(key_col).alias("key"),
                                    F.to_json(F.struct(*weather.columns)).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_topics(frame: DataFrame, bootstrap_servers: str, epoch: str | None = None, acks: str = "all",
                 retries: int = 3, linger_ms: int = 100) -> None:
    """K6: publish ``(topic, key, value)`` with the Kafka sink (needs the Kafka connector). ``epoch`` goes out as a header
    of every record."""
    frame = frame.selectExpr("topic", "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value")
    if epoch is not None:
        frame = frame.withColumn("headers", F.array(F.struct(
            F.lit(landing_zone.EPOCH_HEADER).alias("key"), F.lit(epoch).cast("binary").alias("value"))))
    (frame.write.format("kafka")
          .option("kafka.bootstrap.servers", bootstrap_servers)
          .option("kafka.acks", acks)
          .option("kafka.retries", str(retries))
          .option("kafka.linger.ms", str(linger_ms))
          .option("includeHeaders", str(epoch is not None).lower())
          .save())


def _sender(bootstrap_servers: str | None):
    if bootstrap_servers is None:
        return None
    return lambda frame, epoch: write_topics(frame, bootstrap_servers, epoch)


def publish(frame: DataFrame, landing_path: str, bootstrap_servers: str | None = None,
            epoch: str | None = None) -> str:
    """K6 with the K8 fallback: try the broker, else write the landing zone. Returns the route."""
    return landing_zone.publish_once(frame, landing_path, epoch, _sender(bootstrap_servers))


def publish_batch(landing_path: str, bootstrap_servers: str | None = None, writer: str = "stream"):
    """K8 for streams: a ``foreachBatch`` function that publishes each micro-batch of
    ``(topic, key, value)`` rows to the broker, or to the landing zone when that fails, once per epoch of
    ``writer`` (which tells streams into one landing zone apart)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        publish(batch, landing_path, bootstrap_servers, f"{writer}-{epoch_id}")
    return run
