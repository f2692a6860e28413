"""Deduplication (D1-D3), quality rules (F1-F4) and row accounting.

Survivors of a dedup follow a total order given by the caller, so that results are
repeatable. Both dedup forms reduce copies inside each map task before the shuffle, so a key
with millions of copies never lands whole in one task.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Order(NamedTuple):
    """One sort key of a dedup order; nulls always sort last."""
    column: str
    ascending: bool = True


def _order_list(order) -> list[Order]:
    out = []
    for o in order:
        if isinstance(o, Order):
            out.append(o)
        elif isinstance(o, tuple):
            out.append(Order(*o))
        else:
            out.append(Order(o, True))
    return out


# Stamped by a job, not part of an event: they differ between reruns over the same events.
PROCESSING_COLUMNS = frozenset(("ingestion_timestamp", "processed_timestamp", "data_layer"))


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence = (),
    method: str = "window",
    count_col: str | None = None,
    tie_break: bool = False,
) -> DataFrame:
    """Keep one row per ``keys``: the first row under ``order`` (nulls last).

    ``method="window"`` (default) ranks with ``row_number`` and keeps rank 1; Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every map task forwards one row per key
    and a key with millions of copies never reaches one reducer whole. ``method="aggregate"``
    takes ``min``/``max`` of a struct led by the order columns (all ascending or all
    descending), combined map-side as well; ``count_col`` (aggregate only) adds the number of
    rows per key, which the row accounting uses.

    ``tie_break`` appends ``xxhash64`` of the event's columns as the last sort key (T4), so the
    order is total even when the given columns tie, and a task recomputed after an executor loss
    picks the same survivor as the first attempt. It reads every column (no column pruning
    below the dedup), so callers turn it on only when the order has no unique id.
    """
    keys = list(keys)
    order = _order_list(order)
    hashable = [f.name for f in df.schema.fields
                if f.dataType.typeName() != "map" and f.name not in PROCESSING_COLUMNS]
    tb = F.xxhash64(*[F.col(c) for c in hashable]) if tie_break and hashable else None
    directions = {o.ascending for o in order}
    if method == "aggregate" and len(directions) > 1:
        method = "window"
    if method == "window":
        if count_col:
            raise ValueError("count_col needs method='aggregate'")
        sort = [(F.col(o.column).asc_nulls_last() if o.ascending else F.col(o.column).desc_nulls_last())
                for o in order]
        if tb is not None:
            sort.append(tb.asc() if not order or order[-1].ascending else tb.desc())
        sort = sort or [F.lit(0)]
        w = Window.partitionBy(*keys).orderBy(*sort)
        return (df.withColumn("__rn", F.row_number().over(w))
                  .filter(F.col("__rn") == 1).drop("__rn"))

    ascending = directions != {False}
    rest = [c for c in df.columns if c not in keys]
    fields: list[Column] = []
    for i, o in enumerate(order):
        # Nulls last: the null flag sorts first (false < true) when ascending, and the
        # not-null flag leads when descending (true > false under max).
        flag = F.col(o.column).isNull() if ascending else F.col(o.column).isNotNull()
        fields += [flag.alias(f"__n{i}"), F.col(o.column).alias(f"__o{i}")]
    if tb is not None:
        fields.append(tb.alias("__tb"))
    fields.append(F.struct(*[F.col(c) for c in rest]).alias("__row"))
    pick = F.min if ascending else F.max
    aggs = [pick(F.struct(*fields)).alias("__best")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(c) if c in keys else F.col(f"__best.__row.{c}").alias(c) for c in df.columns]
    if count_col:
        cols.append(F.col(count_col))
    return out.select(*cols)


class Rule(NamedTuple):
    """A named row predicate; a row passes when ``passes`` is true (null counts as a failure)."""
    name: str
    passes: Column


def required(*columns: str) -> list[Rule]:
    """The columns must not be null."""
    return [Rule(f"required:{c}", F.col(c).isNotNull()) for c in columns]


def at_least(column: str, low) -> Rule:
    return Rule(f"{column}>={low}", F.col(column) >= F.lit(low))


def greater_than(column: str, low) -> Rule:
    return Rule(f"{column}>{low}", F.col(column) > F.lit(low))


def between(column: str, low, high) -> Rule:
    """Inclusive range."""
    return Rule(f"{column} in [{low},{high}]", (F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))


def traffic_rules(min_speed: float = 0.0, min_free_flow_exclusive: float = 0.0) -> list[Rule]:
    """F1 + F2."""
    return required("city_name", "timestamp", "current_speed", "free_flow_speed") + [
        at_least("current_speed", min_speed),
        greater_than("free_flow_speed", min_free_flow_exclusive),
    ]


def weather_rules(temperature=(-50.0, 60.0), humidity=(0, 100), aqi=(1, 5), min_pm2_5: float = 0.0) -> list[Rule]:
    """F3 + F4."""
    return required("city_name", "timestamp", "temperature", "aqi") + [
        between("temperature", *temperature),
        between("humidity", *humidity),
        between("aqi", *aqi),
        at_least("pm2_5", min_pm2_5),
    ]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep rows that pass every rule. One conjunctive filter, so Catalyst pushes the
    null checks and bounds down to the Parquet scan when nothing blocks them."""
    if not rules:
        return df
    cond = rules[0].passes
    for r in rules[1:]:
        cond = cond & r.passes
    return df.filter(cond)


def first_failed_rule(rules: Sequence[Rule]) -> Column:
    """Name of the first rule (in order) the row fails, or null when it passes all."""
    return F.coalesce(*[F.when(~F.coalesce(r.passes, F.lit(False)), F.lit(r.name)) for r in rules])


def row_accounting(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    rules: Sequence[Rule],
    feed: str,
    method: str = "window",
) -> DataFrame:
    """Counts of input rows, removed duplicates, rejects per rule and output rows.

    Each dedup survivor is classified by the first rule it fails; duplicates are the input
    count minus the survivors. ``method="window"`` counts the input in a separate, column-pruned
    pass and dedups with the map-side group limit; ``"aggregate"`` does it in one pass (the
    dedup aggregate counts copies per key). Returns ``(feed, outcome, rows)``.
    """
    outcome = F.coalesce(first_failed_rule(rules), F.lit("output")).alias("outcome")
    if method == "aggregate":
        survivors = dedup(df, keys, order, method="aggregate", count_col="__copies")
        per = (survivors.select(outcome, F.col("__copies"))
               .groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"), F.sum("__copies").alias("copies")))
        signed = per.select("outcome", "rows", F.col("copies").alias("input_share"))
    else:
        per = dedup(df, keys, order).select(outcome).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))
        total = df.select(F.lit("input").alias("outcome"), F.lit(0).cast("long").alias("rows"),
                          F.lit(1).cast("long").alias("input_share"))
        signed = per.select("outcome", "rows", F.lit(0).cast("long").alias("input_share")).unionByName(total)
    # One small aggregate over the per-outcome rows gives the input and duplicate totals.
    totals = signed.agg(F.sum("input_share").alias("input"),
                        (F.sum("input_share") - F.sum("rows")).alias("duplicate"))
    totals = totals.select(F.explode(F.array(
        F.struct(F.lit("input").alias("outcome"), F.col("input").alias("rows")),
        F.struct(F.lit("duplicate").alias("outcome"), F.col("duplicate").alias("rows")),
    )).alias("r")).select("r.*")
    per_rule = signed.filter(F.col("outcome") != "input").select("outcome", "rows")
    return (totals.unionByName(per_rule)
            .select(F.lit(feed).alias("feed"), "outcome", F.col("rows").cast("long").alias("rows")))
