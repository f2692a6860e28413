"""Bounded samples of labelled rows, the only thing a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict]:
    """((doc_id, label, text), share of each label among all labelled rows).

    At most ``per_class`` documents of either label, taken in the order of a hash of their id.
    Repeated labels of a document count once (the larger one), null ids and labels are left out. The
    chosen ids are at most ``2 * per_class`` rows, which bounds the broadcast.
    """
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where("doc_id is not null and label is not null")
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    total = sum(counts.values())
    return (rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
            .agg(F.first("label").alias("label"), F.min("text").alias("text")),
            {k: v / total for k, v in counts.items()})
