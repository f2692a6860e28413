"""Joins whose large side has hot keys."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of the large side's rows is salted; at most 1 / share keys can be.
HOT_SHARE = 0.001


def join_aggregate(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to an aggregate by the same ``keys``, so that adaptive execution may split a hot key.

    It splits only where both sides are exchanged for the join. The aggregate's own exchange would serve the join as it is; one
    more equality, of a hash of the keys, asks for another.
    """
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.xxhash64(*keys) == F.xxhash64(*[f"_{k}" for k in keys])
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    return left.join(renamed, same, how).drop(*[f"_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """``(*keys, __parts)`` of the keys that hold more than ``share`` of all rows.

    Rows are counted per key with partial aggregation, reading the key columns alone. ``__parts`` is the count in units of
    ``share``, rounded up. At most ``1 / share`` keys can exceed the share, whatever the input.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    unit = counts.agg((F.sum("__n") * F.lit(share)).alias("unit")).scalar()
    return counts.where(F.col("__n") > unit).select(*keys, F.ceil(F.col("__n") / unit).cast("int").alias("__parts"))


def heavy_hitter_join(large: DataFrame, small: DataFrame, keys: Sequence[tuple[str, str]], how: str = "inner",
                      share: float = HOT_SHARE, salt_by: Sequence[str] | None = None) -> DataFrame:
    """``large`` joined to ``small`` on ``(small column, large column)`` pairs; hot keys are dealt over many tasks.

    ``small`` has one row per key. The measured hot keys (``hot_keys``) are broadcast, which their
    number bounds; each of their rows of ``large`` takes one of ``__parts`` salts by a hash of ``salt_by`` (all columns
    by default, so a recomputed task deals alike), and their rows of ``small`` are repeated once per salt.
    All other keys have salt 0 and one copy. One plan: counting is part of it. Keeps the columns of both sides.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"a {how} join would return copies of the small side")
    alias, src = [k[0] for k in keys], [k[1] for k in keys]
    hot = hot_keys(large.select(*src), src, share)
    hot = hot.select(*[F.col(c).alias(f"__hot_{i}") for i, c in enumerate(src)], "__parts")

    def marked(df, cols):
        same = [F.col(c) == F.col(f"__hot_{i}") for i, c in enumerate(cols)]
        return df.join(F.broadcast(hot), same, "left").drop(*[f"__hot_{i}" for i in range(len(cols))])

    deal = F.xxhash64(*[F.col(c) for c in (salt_by or [f.name for f in large.schema.fields
                                                       if f.dataType.typeName() != "map"])])
    left = marked(large, src).withColumn(
        "__salt", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(deal, F.col("__parts")).cast("int"))).drop("__parts")
    right = marked(small, alias).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    same = [F.col(s) == F.col(a) for a, s in keys] + [F.col("__salt") == F.col("__copy")]
    return left.join(right, same, how).drop("__salt", "__copy")
