"""Landing-zone and layer readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.session import path_exists

# Microsecond timestamps in landing JSON (the writer's default keeps milliseconds only).
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None)
    name = cond() if callable(cond) else getattr(e, "getErrorClass", lambda: None)()
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_landing(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True,
                 glob: str | None = "*.json") -> DataFrame:
    """Landing JSON read with the declared schema (no inference).

    ``multi_line=True`` reads one (possibly indented) object per file, the producer's file
    form; ``False`` reads JSON lines. A missing folder gives a typed empty frame.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line).options(**JSON_TIME_OPTIONS)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        return reader.json(path)
    except AnalysisException as e:
        if _missing(e):
            return empty(spark, schema)
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A layer table, or ``None`` when it does not exist."""
    if not path_exists(spark, path):
        return None
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if _missing(e):
            return None
        raise


def read_gold_for_training(spark: SparkSession, analytics_path: str, mart_path: str) -> DataFrame:
    """The analytics table if present, else the feature mart; an error if neither exists."""
    for p in (analytics_path, mart_path):
        df = read_table(spark, p)
        if df is not None:
            return df
    raise FileNotFoundError(f"no gold table at {analytics_path} or {mart_path}")


def write_landing_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Events as JSON lines in a landing folder (microsecond timestamps)."""
    df.write.mode(mode).options(**JSON_TIME_OPTIONS).json(path)
