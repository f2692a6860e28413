"""Layer metadata (P1) and calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.temporal import parse_event_time, parts_of_wall_clock, wall_clock

TEMPORAL_COLUMNS = ("hour", "day_of_week", "day_of_month", "month", "year", "is_weekend")


def add_layer_metadata(df: DataFrame, layer: str, time_col: str | None) -> DataFrame:
    """Stamp the processing time (when ``time_col`` is given) and the layer name."""
    cols = {}
    if time_col:
        cols[time_col] = F.current_timestamp()
    cols["data_layer"] = F.lit(layer)
    return df.withColumns(cols)


def add_temporal_features(df: DataFrame, text_col: str = "timestamp", tz: str = "UTC",
                          out_col: str = "event_timestamp") -> DataFrame:
    """Parse the ISO text to ``out_col`` and derive calendar parts in zone ``tz``.

    Unparsable text gives a null time and null parts (``try_to_timestamp``). The parse and the
    zone shift are separate columns that every part refers to, so each runs once per row
    (Catalyst does not inline an expensive expression into several consumers).
    """
    df = df.withColumn(out_col, parse_event_time(text_col))
    df = df.withColumn("__wall", wall_clock(F.col(out_col), tz))
    return df.withColumns(parts_of_wall_clock("__wall")).drop("__wall")
