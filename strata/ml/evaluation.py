"""Split, scaling and metrics as plain aggregates (X2, X3, X6), which any SQL engine can repeat."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.rounding import round_half_up

METRIC_DIGITS = 4


def split_bucket(keys: Sequence[str], seed: int, buckets: int = 100) -> Column:
    """A number below ``buckets`` from 32 bits of the md5 of the seed and the row's keys as text. It depends on
    the keys alone: not on the partitioning, the engine or the other rows."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean and the sample standard deviation of each column, ``mean_<c>`` and ``std_<c>``."""
    return df.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_samp(c).alias(f"std_{c}") for c in columns])


def scale(df: DataFrame, columns: Sequence[str], by: DataFrame) -> DataFrame:
    """``columns`` centred and divided by their deviation; a column that does not vary becomes 0. ``by`` is
    the one row of ``scaler``, read as a scalar subquery: no join, nothing on the driver."""
    stats = by.select(F.struct("*").alias("s")).scalar()
    df = df.withColumn("__s", stats)

    def scaled(c):
        deviation = F.col(f"__s.std_{c}")
        return F.when(F.coalesce(deviation, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
            (F.col(c) - F.col(f"__s.mean_{c}")) / deviation)

    return df.withColumns({c: scaled(c) for c in columns}).drop("__s")


def regression_metrics(scored: DataFrame, by: Sequence[str] = ("model",), label: str = "label",
                       prediction: str = "prediction", digits: int = METRIC_DIGITS) -> DataFrame:
    """``(*by, rows, rmse, mae, r2_score)`` of all models in one pass.

    Every metric follows from sums that merge (count, errors, squared errors, labels, squared labels), so map tasks
    return one row per model. R2 is 1 for at most one row, as in the original, and null where labels do not vary. Rows without a
    label or prediction are left out; without rows the metrics are null.
    """
    y, error = F.col(label).cast("double"), (F.col(prediction) - F.col(label)).cast("double")
    sums = scored.where(error.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.abs(error)).alias("a"), F.sum(error * error).alias("e"),
        F.sum(y).alias("y"), F.sum(y * y).alias("yy"))
    n = F.col("rows")
    around_mean = F.col("yy") - F.try_divide(F.col("y") * F.col("y"), n)
    r2 = F.when(n <= 1, F.lit(1.0)).when(around_mean > 0, F.lit(1.0) - F.try_divide(F.col("e"), around_mean))
    return sums.select(*by, "rows",
                       round_half_up(F.sqrt(F.try_divide(F.col("e"), n)), digits).alias("rmse"),
                       round_half_up(F.try_divide(F.col("a"), n), digits).alias("mae"),
                       round_half_up(r2, digits).alias("r2_score"))
