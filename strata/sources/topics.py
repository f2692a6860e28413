"""Topics into bronze with stored offsets (ST1, W5).

A bronze append writes the events of one batch into its own folder and then one offset file, which names the batch and the next
offset of every topic partition. Readers take batches that an offset file names, and the next append starts at its offsets: an append
that died is replaced, and records are neither lost nor read twice, however the reads are cut.

::

    <bronze>/ingest_batch=<n>/city_name=<name>/part-*.parquet
    <bronze>/_offsets/part-*.parquet     (batch, topic, partition, next_offset)
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.layers import add_layer_metadata
from strata.schemas import I, L, S, struct
from strata.session import checkpoint_root, remove_path, scratch_path
from strata.sinks.writers import write_layer
from strata.sources.landing import JSON_TIME_OPTIONS, empty, read_table

OFFSETS = struct(batch=L, topic=S, partition=I, next_offset=L)
BATCH = "ingest_batch"


def _offset_files(spark: SparkSession, bronze: str) -> DataFrame:
    found = read_table(spark, f"{bronze.rstrip('/')}/_offsets", OFFSETS)
    return empty(spark, OFFSETS) if found is None else found


def last_batch(spark: SparkSession, bronze: str) -> int:
    return _offset_files(spark, bronze).agg(F.max("batch")).first()[0] or 0


def stored_offsets(spark: SparkSession, bronze: str) -> DataFrame:
    """``(topic, partition, next_offset)`` after the last append."""
    return (_offset_files(spark, bronze).groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset")))


def starting_offsets(spark: SparkSession, bronze: str) -> str:
    """The broker source's ``startingOffsets`` for the next read: JSON, or ``earliest`` before the first append. Offsets are
    one row per topic partition."""
    by_topic: dict[str, dict[str, int]] = {}
    for r in stored_offsets(spark, bronze).collect():
        by_topic.setdefault(r.topic, {})[str(r.partition)] = r.next_offset
    return json.dumps(by_topic, sort_keys=True) if by_topic else "earliest"


def read_topic_batch(spark: SparkSession, bootstrap_servers: str, topics: Sequence[str], starting: str) -> DataFrame:
    """ST1 as a batch: records from ``starting`` up to now (needs the Kafka connector on the classpath, which wants
    every partition of the topics named in ``starting``)."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
            .option("endingOffsets", "latest")
            .option("includeHeaders", True)
            .load())


def with_offsets(records: DataFrame, order: Column) -> DataFrame:
    """Adds ``offset`` to records with a ``topic`` and a ``partition``: each one's place in its topic partition by ``order``.

    The few topic partitions are sorted by many tasks: records are dealt into ranges of the order and stored, each range is
    numbered by itself and starts where the ranges before it end.
    """
    spark, keys = records.sparkSession, ["topic", "partition"]
    dealt, numbered = scratch_path(spark, "topic-ranges"), scratch_path(spark, "topic-records")
    (records.withColumn("__order", order).repartitionByRange(*keys, "__order", F.xxhash64("value"))
     .withColumn("__range", F.spark_partition_id()).write.parquet(dealt))
    ranges = spark.read.parquet(dealt)
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("n"))  # one row per range
              .select(*keys, "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")))
    within = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy("__order"))
    (ranges.withColumn("__within", within).join(F.broadcast(starts), [*keys, "__range"])
     .select(*records.columns, (F.col("__start") + F.col("__within") - 1).alias("offset")).write.parquet(numbered))
    remove_path(spark, dealt)
    return spark.read.parquet(numbered)


def append_bronze(spark: SparkSession, records: DataFrame, bronze: str, schema: T.StructType,
                  stamp_ingestion: bool = True) -> dict:
    """W1 from topic records ``(topic, partition, offset, key, value)``: those at or after the stored offsets, as one batch.

    Returns the batch number and how many records it read. Nothing new writes nothing.
    """
    bronze, before = bronze.rstrip("/"), stored_offsets(spark, bronze)
    # one row per topic partition is broadcast, so that records aren't dealt by topic partition
    new = (records.join(F.broadcast(before), ["topic", "partition"], "left")
           .where(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset"))
    # a broker may deliver a record more than once within a read
    ends = new.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.count_distinct("offset").alias("records")).collect()
    batch = last_batch(spark, bronze) + 1
    if not ends:
        return {"layer": "bronze", "path": bronze, "batch": batch - 1, "rows": 0, "skipped": True}
    upto = spark.createDataFrame([(r.topic, r.partition, r.next_offset) for r in ends],
                                 "topic string, partition int, upto long")
    # the batch ends where it was counted, whatever the broker has taken since
    events = (new.join(F.broadcast(upto), ["topic", "partition"]).where(F.col("offset") < F.col("upto"))
              .dropDuplicates(["topic", "partition", "offset"])
              .select(F.from_json(F.col("value").cast("string"), schema, JSON_TIME_OPTIONS).alias("e")).select("e.*"))
    events = add_layer_metadata(events, "Bronze", "ingestion_timestamp" if stamp_ingestion else None)
    write_layer(events, f"{bronze}/{BATCH}={batch}")
    checkpoint_root(spark)
    (upto.select(F.lit(batch).cast("long").alias("batch"), "topic", "partition", F.col("upto").alias("next_offset"))
     .coalesce(1).write.mode("append").parquet(f"{bronze}/_offsets"))
    return {"layer": "bronze", "path": bronze, "batch": batch, "rows": sum(r.records for r in ends)}


def read_bronze(spark: SparkSession, bronze: str, schema: T.StructType) -> DataFrame | None:
    """The batches of a bronze table that an offset file names; ``None`` before the first."""
    last = last_batch(spark, bronze)
    if not last:
        return None
    stored = T.StructType([f for f in schema.fields if f.name != "city_name"]).add(BATCH, "long").add("city_name", "string")
    found = spark.read.schema(stored).parquet(bronze.rstrip("/")).where(F.col(BATCH) <= last)
    return found.select(*schema.names)
