"""Per-row traffic and weather metrics (P8-P12, P16, P17) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.rounding import round_half_even, round_half_up

# Weather condition -> severity (P8); matching is case-sensitive.
SEVERITY_LEVELS = (
    (3, ("Thunderstorm", "Snow", "Heavy Rain")),
    (2, ("Rain", "Drizzle", "Fog", "Mist")),
    (1, ("Clouds", "Haze")),
)

# Congestion level thresholds on the rounded ratio (P12), tested in order.
CONGESTION_LEVELS = ((0.85, "Low"), (0.55, "Medium"))
CONGESTION_LEVEL_ELSE = "High"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def severity_index(condition="weather_condition", levels=SEVERITY_LEVELS, default: int = 0) -> Column:
    cond = _col(condition)
    expr = None
    for score, names in levels:
        expr = (F.when(cond.isin(*names), F.lit(score)) if expr is None
                else expr.when(cond.isin(*names), F.lit(score)))
    return expr.otherwise(F.lit(default))


def speed_ratio(current="current_speed", free="free_flow_speed", digits: int = 4) -> Column:
    """Current / free-flow, half-up to ``digits``; a zero free-flow speed gives null."""
    return round_half_up(F.try_divide(_col(current), _col(free)), digits)


def delay_seconds(current="current_travel_time", free="free_flow_travel_time") -> Column:
    """P10: max(0, current - free); a null difference gives 0 (greatest skips nulls)."""
    return F.greatest(F.lit(0), _col(current) - _col(free))


def congestion_ratio(current="current_speed", free="free_flow_speed", digits: int = 3) -> Column:
    """Current / max(free, 1), half-even to ``digits``."""
    return round_half_even(_col(current) / F.greatest(_col(free), F.lit(1.0)), digits)


def congestion_level(ratio="congestion_ratio", levels=CONGESTION_LEVELS,
                     otherwise: str = CONGESTION_LEVEL_ELSE) -> Column:
    """First threshold the (rounded) ratio reaches; null ratio falls to ``otherwise``."""
    r = _col(ratio)
    expr = None
    for bound, name in levels:
        expr = F.when(r >= bound, F.lit(name)) if expr is None else expr.when(r >= bound, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def predicted_congestion_index(predicted="predicted_speed", free="free_flow_speed") -> Column:
    """round(clamp((1 - pred / max(free, 1)) * 100, 0, 100), 1), half-even."""
    raw = (F.lit(1.0) - _col(predicted) / F.greatest(_col(free), F.lit(1.0))) * F.lit(100.0)
    return round_half_even(F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)), 1)
