"""Streaming sources, the silver stream and the gold refresh (ST1-ST6).

The refreshes (``run_silver_refresh``, ``run_gold_refresh``) give the batch job's tables however events are cut
into micro-batches. ``silver_stream`` is the form with bounded state: ``dropDuplicatesWithinWatermark`` keeps the first
arrival of a key and forgets keys once the event-time watermark has passed them.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import gold
from strata.operators.layers import add_layer_metadata, add_temporal_features
from strata.operators.quality import apply_rules, dedup
from strata.operators.silver import EVENT_KEYS, FIRST_INGESTED
from strata.sinks.snapshots import DAY, DayTables, day_of, stored
from strata.sinks.writers import write_layer
from strata.sources.landing import JSON_TIME_OPTIONS


def read_topics(spark: SparkSession, bootstrap_servers: str, topics: Sequence[str],
                starting_offsets: str = "latest") -> DataFrame:
    """ST1: keyed JSON events from topics (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting_offsets)
            .load())


def parse_topic_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """ST1: ``(key, value)`` records (binary or text) to typed event columns plus the topic.
    Works on a batch or a streaming frame, so it is testable without a broker."""
    value = F.col("value").cast("string")
    parsed = F.from_json(value, schema)
    extra = [F.col("topic")] if "topic" in df.columns else []
    return df.select(*extra, F.col("key").cast("string").alias("key"), parsed.alias("__e")).select(*extra, "key", "__e.*")


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
                   max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """ST2: new landing files as a stream, read with the declared schema."""
    r = spark.readStream.schema(schema).option("multiLine", multi_line).options(**JSON_TIME_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path)


def silver_stream(events: DataFrame, rules, keys: Sequence[str] = ("city_name", "timestamp"),
                  tz: str = "UTC", watermark_delay: str = "1 hour") -> DataFrame:
    """ST4 + ST5: parse event time, watermark, dedup within the watermark, then the batch rules
    and calendar features (dedup before rules, as in the batch job)."""
    timed = add_temporal_features(events, "timestamp", tz)
    deduped = (timed.withWatermark("event_timestamp", watermark_delay)
                    .dropDuplicatesWithinWatermark(list(keys)))
    return add_layer_metadata(apply_rules(deduped, rules), "Silver", "processed_timestamp")


def run_to_table(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ("city_name",),
                 available_now: bool = True, processing_time: str | None = None, fmt: str = "parquet"):
    """ST3: a file sink with a checkpoint (exactly-once across restarts). ``available_now``
    drains what is there and stops; otherwise ``processing_time`` sets the trigger."""
    w = (df.writeStream.format(fmt).option("checkpointLocation", checkpoint)
           .option("path", path).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def silver_tables(spark: SparkSession, root: str, events: T.StructType, tz: str = "UTC") -> DayTables:
    """ST4: the dedup survivors (before the rules) and the silver rows of one feed, which change together."""
    survivors = add_temporal_features(spark.createDataFrame([], events), "timestamp", tz)
    silver = add_layer_metadata(survivors, "Silver", "processed_timestamp")
    return DayTables(spark, root, {"survivors": survivors.schema, "silver": silver.schema})


def silver_refresh_batch(tables: DayTables, rules, writer: str, tz: str = "UTC") -> Callable[[DataFrame, int], None]:
    """ST4 + ST5 without a watermark: a ``foreachBatch`` function that merges a micro-batch.

    The days a batch touches are merged with their survivors of all earlier batches, deduplicated by the batch job's
    total order and committed as one snapshot with silver, the rules over them. So the result does not depend
    on how events are cut into batches or how late they come, no row is dropped for being late, a day that loses its
    last accepted row leaves silver, and a replayed batch changes nothing. Work per batch grows with the touched
    days: survivors of other days are pruned by folder.
    """
    def refresh(batch: DataFrame, epoch_id: int) -> None:
        new = add_temporal_features(batch, "timestamp", tz).withColumn(DAY, day_of())
        days = stored(new.select(DAY).distinct())
        if not tables.committed(writer, epoch_id):
            merged = tables.read("survivors", days).unionByName(new)
            order = [o for o in FIRST_INGESTED if o.column in new.columns]
            merged = dedup(merged, EVENT_KEYS, order, tie_break="event_id" not in new.columns)
            tables.commit(days, {
                "survivors": merged,
                "silver": lambda written: add_layer_metadata(
                    apply_rules(written["survivors"], rules), "Silver", "processed_timestamp"),
            }, writer, epoch_id)
        tables.announce(days)

    return refresh


def run_silver_refresh(events: DataFrame, rules, tables: DayTables, checkpoint: str, tz: str = "UTC",
                       available_now: bool = True):
    """ST2-ST5: stream events into silver through ``silver_refresh_batch``. The checkpoint names the writer."""
    return _run_batches(events, silver_refresh_batch(tables, rules, checkpoint, tz), checkpoint, available_now)


def gold_tables(traffic: DayTables, weather: DayTables, root: str) -> DayTables:
    """ST6: the feature mart and the KPI state per day, which change together."""
    mart = gold.feature_mart(traffic.read("silver"), weather.read("silver"), fallback="none")
    return DayTables(traffic.spark, root, {"mart": mart.schema, "kpi_partials": gold.kpi_partials(mart, period=(DAY,)).schema})


def gold_refresh_batch(traffic: DayTables, weather: DayTables, tables: DayTables, analytics_path: str,
                       writer: str, fallback: str = "none") -> Callable[[DataFrame, int], None]:
    """ST6: a ``foreachBatch`` function that refreshes gold for the days that silver commits touched.

    The hourly join only pairs rows of the same day, so the mart is rebuilt for touched days
    alone; both silver scans are pruned to their folders. KPI state is kept per day as sums and counts
    (``kpi_partials``), committed with the mart; the KPI table is re-derived from that small table. Work per batch
    grows with the touched days, not with the history. A day without a match leaves the mart.
    Touched days stay a DataFrame (semi joins, no collect). A replayed batch rewrites the KPI table alone.
    """
    def refresh(batch: DataFrame, epoch_id: int) -> None:
        if not tables.committed(writer, epoch_id):
            days = stored(batch.select(DAY).distinct())
            mart = gold.feature_mart(traffic.read("silver", days), weather.read("silver", days),
                                     fallback=fallback)
            tables.commit(days, {
                "mart": mart,
                "kpi_partials": lambda written: gold.kpi_partials(written["mart"], period=(DAY,)),
            }, writer, epoch_id)
        kpi = gold.kpi_from_partials(tables.read("kpi_partials"))
        write_layer(kpi, analytics_path, partition_by=("city_name",))

    return refresh


def run_gold_refresh(traffic: DayTables, weather: DayTables, tables: DayTables, analytics_path: str, checkpoint: str,
                     available_now: bool = True, fallback: str = "none"):
    """ST6: follow the commits of both silver groups; refresh gold after each micro-batch.

    New weather for an already processed day re-triggers that day as well as new traffic."""
    days = traffic.changes().unionByName(weather.changes())
    fn = gold_refresh_batch(traffic, weather, tables, analytics_path, checkpoint, fallback)
    return _run_batches(days, fn, checkpoint, available_now)


def _run_batches(source: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool):
    w = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
