"""Gold layer: hourly weather (P5, D2), the traffic-weather join (J1, J2, D3, P6), the feature
mart (P7-P10) and the KPI rollup (A1-A3, O1)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.metrics import delay_seconds, severity_index, speed_ratio
from strata.functions.rounding import round_half_up
from strata.operators.quality import Order, dedup
from strata.operators.skew import heavy_hitter_join

# Weather measures carried to gold, in the mart's column order.
WEATHER_MEASURES = ("temperature", "humidity", "weather_condition", "wind_speed", "aqi",
                    "pm2_5", "pm10", "co", "no2")

# Hourly join keys: weather alias -> traffic column.
HOUR_KEYS = (("w_city", "city_name"), ("w_year", "year"), ("w_month", "month"),
             ("w_day", "day_of_month"), ("w_hour", "hour"))

# T4 for D2: the latest event of the hour survives; the larger event_id breaks ties.
LATEST_EVENT = (Order("event_timestamp", False), Order("event_id", False))

# P7 fills after the join; the other weather columns stay null.
WEATHER_FILLS = {"temperature": 25.0, "humidity": 70, "weather_condition": "Clear", "aqi": 2, "pm2_5": 15.0}

KPI_KEYS = ("city_name", "hour", "is_weekend", "congestion_level")
# KPI averages (output name, mart column, digits).
KPI_AVERAGES = (
    ("avg_current_speed", "current_speed", 2),
    ("avg_free_flow_speed", "free_flow_speed", 2),
    ("avg_congestion_ratio", "congestion_ratio", 4),
    ("avg_temperature", "temperature", 2),
    ("avg_humidity", "humidity", 2),
    ("avg_aqi", "aqi", 2),
    ("avg_pm2_5", "pm2_5", 2),
)


def hourly_weather(weather: DataFrame, measures: Sequence[str] = WEATHER_MEASURES,
                   keys=HOUR_KEYS, order: Sequence = LATEST_EVENT,
                   dedup_method: str = "window") -> DataFrame:
    """P5 + D2: weather keys renamed ``w_*``, one row per location and clock hour."""
    order_cols = [o.column if isinstance(o, Order) else o[0] for o in order]
    order_cols = [c for c in order_cols if c in weather.columns]
    order = [o for o in order if (o.column if isinstance(o, Order) else o[0]) in order_cols]
    narrow = weather.select(*[F.col(src).alias(alias) for alias, src in keys],
                            *measures, *[c for c in order_cols if c not in measures])
    # T4: without an event id among the order columns, a row hash breaks ties.
    tie = "event_id" not in order_cols
    out = dedup(narrow, [alias for alias, _ in keys], order, method=dedup_method, tie_break=tie)
    return out.select(*[alias for alias, _ in keys], *measures)


def _join_condition(traffic: DataFrame, hourly: DataFrame, keys=HOUR_KEYS) -> Column:
    """Equality of all keys, and of one hash of them.

    The hash adds nothing to the result. Without it the weather side, a window over the same keys, meets the
    join in that window's own partitioning, and adaptive execution splits a hot location-hour only where both
    sides of a join are plain exchanges. With it the (small) weather side is exchanged once more.
    """
    cond = None
    for alias, src in keys:
        c = traffic[src] == hourly[alias]
        cond = c if cond is None else cond & c
    if all(traffic.schema[src].dataType == hourly.schema[alias].dataType for alias, src in keys):
        cond = cond & (F.xxhash64(*[traffic[src] for _, src in keys])
                       == F.xxhash64(*[hourly[alias] for alias, _ in keys]))
    return cond


def hourly_join(traffic: DataFrame, hourly: DataFrame, keys=HOUR_KEYS, how: str = "inner",
                hot_share: float | None = None) -> DataFrame:
    """J1 + P6: traffic joined to the weather of the same location and clock hour.

    The weather side is unique per key, so a traffic row gets at most one match. No hint:
    adaptive execution broadcasts the weather side when its runtime size allows; otherwise a
    sort-merge join, whose hot location-hours it splits. With ``hot_share`` location-hours above that share of all
    traffic rows are counted and salted instead (``skew.heavy_hitter_join``), whatever adaptive execution does;
    this suits stored tables, where counting reads the key columns alone.
    """
    if hot_share is not None:
        joined = heavy_hitter_join(traffic, hourly, keys, how, hot_share)
    else:
        joined = traffic.join(hourly, _join_condition(traffic, hourly, keys), how)
    return joined.drop(*[alias for alias, _ in keys])


def latest_weather_by_location(hourly: DataFrame, keys=HOUR_KEYS) -> DataFrame:
    """D3: the latest hourly weather row per location (one row per location)."""
    loc = keys[0][0]
    order = [Order(alias, False) for alias, _ in keys[1:]]
    return dedup(hourly, [loc], order)


def location_fallback_join(traffic: DataFrame, hourly: DataFrame, keys=HOUR_KEYS) -> DataFrame:
    """Traffic left-joined to the latest weather of its location."""
    latest = latest_weather_by_location(hourly, keys)
    loc_alias, loc_src = keys[0]
    joined = traffic.join(latest, traffic[loc_src] == latest[loc_alias], "left")
    return joined.drop(*[alias for alias, _ in keys])


def _with_fallback(traffic: DataFrame, hourly: DataFrame, keys, measures: Sequence[str],
                   any_match: Column | None) -> DataFrame:
    """Traffic with the hourly weather and the location's latest weather in one pass.

    Without ``any_match`` each row takes its hourly weather, else the latest. With it, rows take hourly weather
    and only matched rows stay where it is true; all rows take the latest where it is false.
    """
    loc_alias, loc_src = keys[0]
    latest = latest_weather_by_location(hourly, keys)
    h = hourly.select(*[F.col(a) for a, _ in keys], *[F.col(m).alias(f"__h_{m}") for m in measures],
                      F.lit(True).alias("__matched"))
    lt = latest.select(F.col(loc_alias).alias("__l_city"), *[F.col(m).alias(f"__l_{m}") for m in measures])
    j = traffic.join(h, _join_condition(traffic, h, keys), "left")
    j = j.join(lt, j[loc_src] == lt["__l_city"], "left")
    matched = F.coalesce(F.col("__matched"), F.lit(False))
    if any_match is not None:
        j = j.withColumn("__any", any_match).where(matched | ~F.col("__any"))
        matched = F.col("__any")
    j = j.withColumns({m: F.when(matched, F.col(f"__h_{m}")).otherwise(F.col(f"__l_{m}")) for m in measures})
    drop = [a for a, _ in keys] + ["__matched", "__any", "__l_city"]
    return j.drop(*drop, *[f"__{side}_{m}" for side in "hl" for m in measures])


def per_row_fallback_join(traffic: DataFrame, hourly: DataFrame, keys=HOUR_KEYS,
                          measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """T7 option: hourly weather where it exists, else the location's latest; one plan, no branch."""
    return _with_fallback(traffic, hourly, keys, measures, None)


def hourly_matches(traffic: DataFrame, hourly: DataFrame, keys=HOUR_KEYS) -> DataFrame:
    """Key values of traffic rows with an hourly match; reads the key columns only."""
    left = traffic.select(*[src for _, src in keys])
    right = hourly.select(*[alias for alias, _ in keys])
    return left.join(right, _join_condition(left, right, keys), "left_semi")


def global_fallback_join(traffic: DataFrame, hourly: DataFrame, keys=HOUR_KEYS,
                         measures: Sequence[str] = WEATHER_MEASURES) -> DataFrame:
    """J1, or J2 for all rows when J1 is empty everywhere, in one plan.

    The gate is an uncorrelated ``exists`` over the key columns. It runs as a subquery when the plan is
    executed, beside the other stages; building the plan starts no job, and traffic is joined once.
    """
    gate = hourly_matches(traffic, hourly, keys).exists()
    return _with_fallback(traffic, hourly, keys, measures, gate)


def join_weather(traffic: DataFrame, hourly: DataFrame, fallback: str = "global",
                 keys=HOUR_KEYS, hot_share: float | None = None) -> DataFrame:
    """J1 with the J2 fallback.

    ``fallback="global"`` (the reference): when the hourly join is empty everywhere, use the
    location-level left join instead (``global_fallback_join``). ``"per_row"``: the T7 option.
    ``"none"``: the hourly join only (streaming refreshes, and jobs that decide from
    the row count they observe while writing), with ``hot_share`` as in ``hourly_join``.
    """
    if fallback == "per_row":
        return per_row_fallback_join(traffic, hourly, keys)
    if fallback == "global":
        return global_fallback_join(traffic, hourly, keys)
    return hourly_join(traffic, hourly, keys, hot_share=hot_share)


def add_gold_features(joined: DataFrame, fills: dict | None = None) -> DataFrame:
    """Fills, severity index, speed ratio, delay, gold metadata."""
    fills = WEATHER_FILLS if fills is None else fills
    present = {k: v for k, v in fills.items() if k in joined.columns}
    out = joined.fillna(present) if present else joined
    out = out.withColumns({
        "weather_severity_index": severity_index("weather_condition"),
        "speed_ratio": speed_ratio("current_speed", "free_flow_speed"),
        "delay_time_seconds": delay_seconds("current_travel_time", "free_flow_travel_time"),
        "data_layer": F.lit("Gold"),
        "gold_processed_timestamp": F.current_timestamp(),
    })
    return out


def feature_mart(traffic_silver: DataFrame, weather_silver: DataFrame, fallback: str = "global",
                 dedup_method: str = "window", hot_share: float | None = None) -> DataFrame:
    """W4 (mart half): hourly weather, join with fallback, gold features."""
    hourly = hourly_weather(weather_silver, dedup_method=dedup_method)
    return add_gold_features(join_weather(traffic_silver, hourly, fallback=fallback, hot_share=hot_share))


def kpi_rollup(mart: DataFrame, keys: Sequence[str] = KPI_KEYS, averages=KPI_AVERAGES,
               order_by: Sequence[str] | None = ("city_name", "hour")) -> DataFrame:
    """A1-A3 (+ O1): rounded averages and the observation count per group.

    Partial aggregation runs before the shuffle, so a busy location costs one row per
    map task and group, not its raw rows.
    """
    aggs = [round_half_up(F.avg(src), digits).alias(name) for name, src, digits in averages]
    aggs.append(F.count(F.lit(1)).alias("total_observations"))
    out = mart.groupBy(*keys).agg(*aggs)
    if order_by:
        out = out.orderBy(*order_by)
    return out


DAY_KEYS = ("city_name", "year", "month", "day_of_month")


def kpi_partials(mart: DataFrame, keys: Sequence[str] = KPI_KEYS, period: Sequence[str] = DAY_KEYS[1:],
                 averages=KPI_AVERAGES) -> DataFrame:
    """Mergeable KPI state per group and day: a sum and a non-null count per averaged column,
    plus the row count. Averages over any set of days follow by adding partials."""
    aggs = []
    for _, src, _ in averages:
        aggs += [F.sum(src).cast("double").alias(f"sum_{src}"), F.count(src).alias(f"n_{src}")]
    aggs.append(F.count(F.lit(1)).alias("total_observations"))
    return mart.groupBy(*keys, *period).agg(*aggs)


def kpi_from_partials(partials: DataFrame, keys: Sequence[str] = KPI_KEYS, averages=KPI_AVERAGES) -> DataFrame:
    """A1-A3 from ``kpi_partials``: the same rounded averages and counts as ``kpi_rollup``."""
    aggs = [round_half_up(F.try_divide(F.sum(f"sum_{src}"), F.sum(f"n_{src}")), digits).alias(name)
            for name, src, digits in averages]
    aggs.append(F.sum("total_observations").alias("total_observations"))
    return partials.groupBy(*keys).agg(*aggs)
