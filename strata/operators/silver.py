"""Silver jobs (W2, W3) as pure functions: dedup, quality rules, calendar features."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from strata.operators.layers import add_layer_metadata, add_temporal_features
from strata.operators.quality import (Order, apply_rules, dedup, first_failed_rule, traffic_rules,
                                     weather_rules)

EVENT_KEYS = ("city_name", "timestamp")
# T4: the earliest ingestion survives; event_id breaks ties.
FIRST_INGESTED = (Order("ingestion_timestamp", True), Order("event_id", True))


def silver(
    df: DataFrame,
    rules,
    keys: Sequence[str] = EVENT_KEYS,
    order: Sequence = FIRST_INGESTED,
    tz: str = "UTC",
    filter_first: bool = False,
    dedup_method: str = "window",
    processed_col: str | None = "processed_timestamp",
    reject_col: str | None = None,
) -> DataFrame:
    """Dedup on ``keys`` then quality rules (the reference's order, T5), or rules first with
    ``filter_first=True`` (then a bad copy cannot remove a good one, and the rules reach the scan).

    With ``reject_col`` (dedup-first order only) nothing is filtered: the column names the first
    rule each survivor fails (null when it passes), so a job can count rejects per rule while it
    writes and filter afterwards.
    """
    order = [o for o in order if (o[0] if isinstance(o, tuple) else o) in df.columns]
    # Calendar parts are derived once per row before the dedup and ride through it. Derived
    # after it, they would be functions of the dedup key, and the null checks Catalyst infers
    # from the hourly join would be pushed below the aggregate into the scan, re-parsing the
    # text once per part and per row.
    timed = add_temporal_features(df, "timestamp", tz)
    # T4: the order ends in a unique id when there is one; otherwise a row hash breaks ties.
    tie = "event_id" not in df.columns
    if filter_first:
        clean = dedup(apply_rules(timed, rules), keys, order, method=dedup_method, tie_break=tie)
    elif reject_col:
        clean = (dedup(timed, keys, order, method=dedup_method, tie_break=tie)
                 .withColumn(reject_col, first_failed_rule(rules)))
    else:
        clean = apply_rules(dedup(timed, keys, order, method=dedup_method, tie_break=tie), rules)
    return add_layer_metadata(clean, "Silver", processed_col)


def silver_traffic(df: DataFrame, **kw) -> DataFrame:
    """W2 over a bronze traffic frame."""
    return silver(df, traffic_rules(), **kw)


def silver_weather(df: DataFrame, **kw) -> DataFrame:
    """W3 over a bronze weather frame."""
    return silver(df, weather_rules(), **kw)
