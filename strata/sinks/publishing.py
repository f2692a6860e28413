"""Incremental publish of layer tables (K9) and file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import L, S, struct
from strata.session import path_exists, qualified_path, remove_path
from strata.sinks.writers import write_layer
from strata.sources.landing import empty, read_table

PUBLISHED = struct(relative=S, length=L)
SUMMARY = ("layer string, total_files long, uploaded_files long, skipped_files long, bytes long")


def object_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``: ``path``, ``relative`` (to ``path``), ``length`` and ``modificationTime``.
    File contents are not read; hidden and ``_``-prefixed files are skipped by the file index."""
    root = qualified_path(spark, path)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", F.substr("path", F.lit(len(root) + 2)).alias("relative"), "length", "modificationTime"))


def partition_columns(manifest: DataFrame) -> list[str]:
    """The partition columns of a table, read off the folder names of one file."""
    first = manifest.select("relative").first()
    return [part.split("=")[0] for part in first.relative.split("/")[:-1]] if first else []


def read_as_text(spark: SparkSession, path: str, folders: list[str] | None = None) -> DataFrame:
    """A layer table whose partition values stay text (a location named "007" keeps its zeros); of some
    partition folders alone if given."""
    data = spark.read.option("recursiveFileLookup", True).parquet(path).schema
    names = partition_columns(object_manifest(spark, path))
    schema = T.StructType([f for f in data.fields if f.name not in names] + [T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*([path] if folders is None else [f"{path}/{f}" if f else path for f in folders]))


def _folder():
    return F.regexp_replace("relative", "/?[^/]*$", "")


def publish_layer(spark: SparkSession, src: str, dst: str, layer: str | None = None) -> DataFrame:
    """K9: bring the copy of a layer table at ``dst`` (any URI the cluster can write) up to date.

    The files of ``src`` are compared by relative path and length with those that the last publish covered, a
    manifest kept at ``dst``. Only the partition folders with a new, changed or removed file are written again, by
    Spark; folders that are gone go. The manifest is written last: a publish that died copies its folders again.
    A missing source is no error and changes nothing. Returns one row: files in the source, in folders written now and in
    folders left alone, and bytes in the source.
    """
    name, src, dst = layer or dst, src.rstrip("/"), dst.rstrip("/")
    if not path_exists(spark, src):
        return spark.createDataFrame([(name, 0, 0, 0, 0)], SUMMARY)
    files = object_manifest(spark, src).select("relative", "length")
    known = read_table(spark, f"{dst}/_published", PUBLISHED)
    known = empty(spark, PUBLISHED) if known is None else known
    same = ["relative", "length"]
    differ = files.join(known, same, "left_anti").unionByName(known.join(files, same, "left_anti"))
    here = files.groupBy(_folder().alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    # one row per partition folder, like the listing that Spark itself keeps of a table
    folders = here.join(differ.select(_folder().alias("folder"), F.lit(True).alias("changed")).distinct(),
                        "folder", "full").fillna({"changed": False, "files": 0, "bytes": 0}).collect()
    changed = [f.folder for f in folders if f.changed and f.files]
    if changed:
        columns = partition_columns(object_manifest(spark, src))
        write_layer(read_as_text(spark, src, changed), dst, partition_by=columns,
                    replace="partitions" if columns else "table")
    for folder in (f.folder for f in folders if not f.files and f.folder):
        remove_path(spark, f"{dst}/{folder}")
    if any(f.changed for f in folders):
        files.coalesce(1).write.mode("overwrite").parquet(f"{dst}/_published")
    total, sent = sum(f.files for f in folders), sum(f.files for f in folders if f.changed)
    return spark.createDataFrame([(name, total, sent, total - sent, sum(f.bytes for f in folders))], SUMMARY)
