"""Corpus pipeline: five stages from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept, and returns the
columns of ``documents`` (the last one: pieces). ``run`` writes each stage's rows as Parquet
below the checkpoint folder and reads them again for the next.

1. ``quality``: documents that the quality classifier rejects go. Its network learns from labels
   whose id remainder modulo 5 is not 0, its word vectors from all documents of the stage.
2. ``line_dedup``: lines similar to an earlier line are cut; ``n_chars`` follows the text. A
   document that loses all its lines goes; one that had none stays.
3. ``near_dedup``: one document of each SimHash component stays, that with the smallest id. Rows
   that repeat this id are one document: one of them stays, by text hash.
4. ``decontaminate``: documents that share a window with a benchmark item go.
5. ``pack``: token windows.

Null ids and texts are kept like others; an empty table passes through empty. Columns beyond those of
``documents`` are dropped.

A stage's rows are removed from the checkpoint folder once the next stage has written its own; the last ones stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table
from strata.llm.decontam import clean_documents
from strata.llm.line_dedup import remove_lines
from strata.llm.packing import pack
from strata.llm.quality_classifier import score
from strata.llm.queries import PIECE_COLUMNS, QUALITY_THRESHOLD, bpe_encoder, quality_model
from strata.llm.simhash import one_of_each
from strata.session import remove_path, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, COLUMNS, least=QUALITY_THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = remove_lines(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    return (cut.where(~changed | (F.col("n_removed") < F.col("n_lines")))
            .withColumn("n_chars", F.when(changed, F.char_length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, bpe_encoder).select(*PIECE_COLUMNS)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("pack", packing)]

# A classifier, an iterative component search and a tokenizer are beyond SQL; tests/llm/test_pipeline.py
# holds the rows of each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
