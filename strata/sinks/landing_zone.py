"""The landing zone as an idempotent sink (K6, K8): one folder per epoch and a ledger that readers honour.

::

    <path>/topic=<name>/epoch=<label>/part-*.txt
    <path>/_ledger/part-*.parquet      (epoch, route, failure)

An epoch is a micro-batch of a stream or one batch publish. Its events go to the broker, or to its own folders when that
fails; then a ledger row says which. A replayed epoch that the ledger names is done. One that it does not name replaces its
folders, so an epoch lands once however often it was tried. Readers take only folders whose epoch the ledger
routes to landing. Broker records carry their epoch as a header, so what a broker took before it failed can be
told apart as well (``only_routed``).
"""

from __future__ import annotations

import logging
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import S, struct
from strata.sources.landing import JSON_TIME_OPTIONS, empty, read_table

log = logging.getLogger(__name__)

LEDGER = struct(epoch=S, route=S, failure=S)
TOPICS, LANDING = "topics", "landing"
EPOCH_HEADER = "epoch"


def new_epoch() -> str:
    """Label of a publish that has no epoch of its own."""
    return f"run-{uuid.uuid4().hex[:12]}"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    found = read_table(spark, f"{path.rstrip('/')}/_ledger", LEDGER)
    return empty(spark, LEDGER) if found is None else found


def route_of(spark: SparkSession, path: str, epoch: str) -> str | None:
    row = ledger(spark, path).where(F.col("epoch") == epoch).first()
    return row and row.route


def record(spark: SparkSession, path: str, epoch: str, route: str, failure: str | None = None) -> None:
    """Enter an epoch into the ledger: one file, renamed into place."""
    (spark.createDataFrame([(epoch, route, failure)], LEDGER).coalesce(1)
     .write.mode("append").parquet(f"{path.rstrip('/')}/_ledger"))


def write_epoch(frame: DataFrame, path: str, epoch: str) -> None:
    """The folders of one epoch, replaced if they are there; not in the ledger yet."""
    (frame.select("topic", F.lit(epoch).alias("epoch"), "value").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "epoch").text(path))


def write_landing(frame: DataFrame, path: str, epoch: str | None = None) -> str:
    """K8: the landing-zone fallback: event JSON, once per epoch. Returns the epoch's label."""
    spark, epoch = frame.sparkSession, epoch or new_epoch()
    if route_of(spark, path, epoch) is None:
        write_epoch(frame, path, epoch)
        record(spark, path, epoch, LANDING)
    return epoch


def read_epochs(spark: SparkSession, path: str, topic: str, schema: T.StructType) -> DataFrame:
    """S1 over the landing zone: events of the epochs that the ledger routes to landing.

    The ledger is small and filtered, so the folders of other epochs are pruned at run time.
    """
    stored = T.StructType(list(schema.fields)).add("epoch", "string")
    routed = ledger(spark, path).where(F.col("route") == LANDING).select("epoch")
    if routed.where(F.col("epoch").isNotNull()).isEmpty():
        return empty(spark, schema)
    files = (spark.read.schema(stored).options(**JSON_TIME_OPTIONS)
             .json(f"{path.rstrip('/')}/topic={topic}"))
    return files.join(routed, "epoch", "left_semi").select(*schema.names)


def only_routed(records: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Topic records (with ``headers``) whose epoch the ledger routes to the broker, and those without an epoch.

    A broker that failed half way keeps some records of an epoch that landed as files; these go.
    """
    header = F.filter("headers", lambda h: h["key"] == EPOCH_HEADER)
    marked = records.withColumn("__epoch", F.try_element_at(header, F.lit(1))["value"].cast("string"))
    routed = ledger(spark, path).where(F.col("route") == TOPICS).select(F.col("epoch").alias("__epoch"), F.lit(True).alias("__ok"))
    return (marked.join(routed, "__epoch", "left").where(F.col("__epoch").isNull() | F.col("__ok"))
            .drop("__epoch", "__ok"))


def publish_once(frame: DataFrame, path: str, epoch: str | None,
                 send: Callable[[DataFrame, str], None] | None) -> str:
    """K6 with the K8 fallback, once per epoch. ``send`` publishes to a broker; if it fails the error is logged and kept in
    the ledger, and the epoch lands as files. Returns the route."""
    spark, epoch = frame.sparkSession, epoch or new_epoch()
    done = route_of(spark, path, epoch)
    if done:
        log.info("epoch %s was published before (%s)", epoch, done)
        return done
    failure = None
    if send is not None:
        try:
            send(frame, epoch)
        except Exception as error:  # noqa: BLE001 - whatever the connector raises routes to the fallback
            failure = f"{type(error).__name__}: {error}"[:1000]
            log.error("broker publish of epoch %s failed, landing it: %s", epoch, failure)
        else:
            record(spark, path, epoch, TOPICS)
            return TOPICS
    write_epoch(frame, path, epoch)
    record(spark, path, epoch, LANDING, failure)
    return LANDING
