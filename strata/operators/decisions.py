"""Decision rules (R1-R8) over scored rows: alerts, recommendations and a travel window.

All rules are column expressions, so a whole table (or a stream) is scored in one pass.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.rounding import round_half_even

# Rule thresholds.
HEAVY_PREDICTED_SPEED_BELOW = 15.0
HEAVY_SPEED_DROP_ABOVE = 20.0
PEAK_RANGES = ((8, 10), (17, 20))
POOR_PREDICTED_AQI_FROM = 3.5
POOR_CURRENT_AQI_FROM = 4
ADVERSE_CONDITIONS = ("rain", "thunderstorm", "drizzle", "mist")

# Message texts; %s is filled in the order given in the comment.
HEAVY_ALERT = "⚠️ Heavy congestion expected in %s during the next hour. (Predicted Speed: %s km/h)"  # location, predicted speed
HEAVY_RECOMMENDATION = "Consider alternative routes via Western/Eastern Express Highway to bypass %s."  # location
PEAK_ALERT = "🚨 Peak traffic rush hour active in %s."  # location
OFF_PEAK_RECOMMENDATION = "Traffic flow in %s is currently near optimal speed."  # location
AQI_ALERT = "😷 Poor AQI predicted in %s (AQI Level: %s)."  # location, predicted aqi
AQI_RECOMMENDATION = "Air quality alert: Sensitive groups should limit outdoor activity in this zone."
WEATHER_ALERT = "🌧️ Adverse weather (%s) likely to increase travel times in %s by 25-40%%."  # condition, location
NORMAL_ALERT = "✅ Traffic and environmental metrics normal in %s."  # location
DEFAULT_WINDOW = "Optimal travel window: 11:00 AM - 1:30 PM & 9:00 PM - 11:00 PM"
PEAK_WINDOW = "Recommended travel window: Post 8:30 PM or between 1:00 PM - 4:00 PM"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _in_ranges(hour: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    cond = None
    for lo, hi in ranges:
        c = hour.between(lo, hi)
        cond = c if cond is None else cond | c
    return cond


def recommend(
    df: DataFrame,
    location="city_name",
    current_speed="current_speed",
    predicted_speed="predicted_speed",
    current_aqi="aqi",
    predicted_aqi="predicted_aqi",
    weather_condition="weather_condition",
    hour="hour",
    peak_ranges: Sequence[tuple[int, int]] = PEAK_RANGES,
) -> DataFrame:
    """R1-R8. Adds ``speed_drop_percent``, ``alerts``, ``recommendations`` (ordered arrays of the
    rules that fired), ``primary_alert`` and ``recommended_travel_window``."""
    loc, cur, pred = _c(location), _c(current_speed), _c(predicted_speed)
    cur_aqi, pred_aqi, cond, hr = _c(current_aqi), _c(predicted_aqi), _c(weather_condition), _c(hour)

    drop = round_half_even((cur - pred) / F.greatest(cur, F.lit(1.0)) * F.lit(100.0), 1)
    df = df.withColumn("speed_drop_percent", drop)
    heavy = (pred < HEAVY_PREDICTED_SPEED_BELOW) | (F.col("speed_drop_percent") > HEAVY_SPEED_DROP_ABOVE)
    peak = _in_ranges(hr, peak_ranges)
    poor_air = (pred_aqi >= POOR_PREDICTED_AQI_FROM) | (cur_aqi >= POOR_CURRENT_AQI_FROM)
    adverse = F.lower(cond).isin(*ADVERSE_CONDITIONS)

    def fired(c: Column, text: Column) -> Column:
        return F.when(F.coalesce(c, F.lit(False)), text)

    alerts = F.array_compact(F.array(
        fired(heavy, F.format_string(HEAVY_ALERT, loc, pred.cast("string"))),
        fired(peak, F.format_string(PEAK_ALERT, loc)),
        fired(poor_air, F.format_string(AQI_ALERT, loc, pred_aqi.cast("string"))),
        fired(adverse, F.format_string(WEATHER_ALERT, cond, loc)),
    ))
    recommendations = F.array_compact(F.array(
        fired(heavy, F.format_string(HEAVY_RECOMMENDATION, loc)),
        fired(~F.coalesce(peak, F.lit(False)), F.format_string(OFF_PEAK_RECOMMENDATION, loc)),
        fired(poor_air, F.lit(AQI_RECOMMENDATION)),
    ))
    return df.withColumns({
        "alerts": alerts,
        "recommendations": recommendations,
    }).withColumns({
        "primary_alert": F.coalesce(F.get(F.col("alerts"), 0), F.format_string(NORMAL_ALERT, loc)),
        "recommended_travel_window": F.when(F.coalesce(peak, F.lit(False)), F.lit(PEAK_WINDOW))
                                      .otherwise(F.lit(DEFAULT_WINDOW)),
    })
