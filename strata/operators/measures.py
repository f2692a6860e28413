"""BI measures over the gold analytics table.

A measure takes a slice of the analytics table: ``measures(df, by=[...])`` groups by any subset
of its key columns; ``by=[]`` gives the grand total. Like the BI tool, averages are means of the
group means (unweighted) unless ``weighted=True``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.rounding import round_half_up

# Peak hours of the congestion measure.
PEAK_HOURS = (8, 9, 17, 18, 19)

# Weather risk levels (M8), first match wins.
EXTREME_HEAT_ABOVE = 35.0
HAZARDOUS_AQI_FROM = 4.0
HEAVY_CONGESTION_BELOW = 0.65
RISK_LABELS = ("Extreme Heat", "Hazardous Air Quality", "Heavy Congestion Delay", "Optimal Traffic Flow")


def _mean(col: str, weighted: bool, weight: str, cond: Column | None = None) -> Column:
    x = F.col(col) if cond is None else F.when(cond, F.col(col))
    if not weighted:
        return F.avg(x)
    w = F.when(x.isNotNull(), F.col(weight))
    return F.try_divide(F.sum(x * w), F.sum(w))


def measures(
    analytics: DataFrame,
    by: Sequence[str] = (),
    peak_hours: Sequence[int] = PEAK_HOURS,
    weighted: bool = False,
    weight_col: str = "total_observations",
    digits: int | None = None,
) -> DataFrame:
    """M1-M8 per slice. An empty slice gives nulls (``weather_risk_level`` too)."""
    m1 = _mean("avg_congestion_ratio", weighted, weight_col)
    temp = _mean("avg_temperature", weighted, weight_col)
    aqi = _mean("avg_aqi", weighted, weight_col)
    numeric = {
        "avg_congestion_ratio": m1,
        "avg_current_speed": _mean("avg_current_speed", weighted, weight_col),
        "avg_free_flow_speed": _mean("avg_free_flow_speed", weighted, weight_col),
        "congestion_index_pct": (F.lit(1.0) - m1) * F.lit(100.0),
        "peak_hour_congestion": _mean("avg_congestion_ratio", weighted, weight_col,
                                      F.col("hour").isin(*peak_hours)),
        "average_aqi": aqi,
        "average_pm2_5": _mean("avg_pm2_5", weighted, weight_col),
    }
    risk = (F.when(F.count(F.lit(1)) == 0, F.lit(None).cast("string"))
             .when(temp > EXTREME_HEAT_ABOVE, F.lit(RISK_LABELS[0]))
             .when(aqi >= HAZARDOUS_AQI_FROM, F.lit(RISK_LABELS[1]))
             .when(m1 < HEAVY_CONGESTION_BELOW, F.lit(RISK_LABELS[2]))
             .otherwise(F.lit(RISK_LABELS[3])))
    by = list(by)
    outer = [c for c in by if c != "hour"]
    if len(outer) < len(by):
        # The peak measure replaces any filter on ``hour`` (M5): when the slice is by hour, it is
        # taken over the slice without the hour and joined back on the remaining keys.
        peak = numeric.pop("peak_hour_congestion")
    aggs = [(round_half_up(e, digits) if digits is not None else e).alias(n) for n, e in numeric.items()]
    aggs.append(risk.alias("weather_risk_level"))
    grouped = analytics.groupBy(*by) if by else analytics.groupBy()
    out = grouped.agg(*aggs)
    if len(outer) == len(by):
        return out
    peak_col = (round_half_up(peak, digits) if digits is not None else peak).alias("peak_hour_congestion")
    if outer:
        joined = out.join(analytics.groupBy(*outer).agg(peak_col), outer, "left")
    else:  # sliced by hour alone: one value over the whole table, an uncorrelated scalar subquery
        joined = out.withColumn("peak_hour_congestion", analytics.agg(peak_col).scalar())
    cols = by + ["avg_congestion_ratio", "avg_current_speed", "avg_free_flow_speed", "congestion_index_pct",
                 "peak_hour_congestion", "average_aqi", "average_pm2_5", "weather_risk_level"]
    return joined.select(*cols)
