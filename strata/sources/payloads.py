"""Raw API payload flattening (S11-S13) and the weather + air-quality merge.

Input is a landing table of raw response bodies ``(city_name, latitude, longitude, poll_id,
body[, fetched_at])``. Bodies are parsed with declared schemas by ``from_json``; an absent or
null field takes the preset default, while a body that is not a JSON object is not filled
with made-up values: its measures stay null and ``payload_error`` names the problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.metrics import congestion_level, congestion_ratio
from strata.functions.temporal import iso_utc_text
from strata.schemas import AIR_PAYLOAD_SCHEMA, TRAFFIC_PAYLOAD_SCHEMA, WEATHER_PAYLOAD_SCHEMA

# Defaults for fields missing from the traffic payload.
TRAFFIC_DEFAULTS = {"currentSpeed": 0.0, "freeFlowSpeed": 1.0, "currentTravelTime": 0,
                    "freeFlowTravelTime": 0, "confidence": 1.0, "roadClosure": False}
# Defaults for the weather payload.
WEATHER_DEFAULTS = {"temp": 25.0, "feels_like": 25.0, "humidity": 50, "pressure": 1013,
                    "wind_speed": 3.5, "condition": "Clear"}
# Defaults for the air-quality payload.
AIR_DEFAULTS = {"aqi": 2, "co": 250.0, "no2": 20.0, "o3": 60.0, "so2": 5.0, "pm2_5": 15.0, "pm10": 30.0}
# Source tags.
TRAFFIC_SOURCE = "TomTom_API"
WEATHER_SOURCE = "OpenWeather_API"

UNPARSABLE = "unparsable body"
WRONG_TYPE = "value of a wrong type"
_CORRUPT = "_corrupt_body"


def _parsed(raw: DataFrame, body: str, schema) -> DataFrame:
    """The body parsed once into ``__p`` and its validity computed once into ``__ok``; field
    extraction then reads these columns (Catalyst does not inline an expensive expression into
    several consumers), so each body is parsed once, not once per field. A body is valid if it is a JSON object; only
    one that the parse complains of is looked at again, since a value of a wrong type is a complaint too."""
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType(), True)])
    parsed = F.from_json(F.col(body), marked, {"columnNameOfCorruptRecord": _CORRUPT})
    ok = (F.col(body).rlike(r"^\s*\{")
          & (F.col("__p")[_CORRUPT].isNull() | F.json_object_keys(F.col(body)).isNotNull()))
    return raw.withColumn("__p", parsed).withColumn("__ok", F.coalesce(ok, F.lit(False)))


def _pick(ok: Column, value: Column, default) -> Column:
    """An absent or null field takes the default; in a body with a value of a wrong type it
    stays null, because the parse cannot tell which field held it."""
    wrong = F.col("__p")[_CORRUPT].isNotNull()
    return F.when(ok, F.when(wrong, value).otherwise(F.coalesce(value, F.lit(default))))


def _error(ok: Column) -> Column:
    return (F.when(~ok, F.lit(UNPARSABLE))
            .when(F.col("__p")[_CORRUPT].isNotNull(), F.lit(WRONG_TYPE)))


def _stamp(time_col: str | None) -> Column:
    return iso_utc_text(F.col(time_col) if time_col else None)


def flatten_traffic(raw: DataFrame, body: str = "body", time_col: str | None = "fetched_at",
                    source: str = TRAFFIC_SOURCE, defaults: dict = TRAFFIC_DEFAULTS) -> DataFrame:
    """S11 + P11 + P12 + P13: one traffic event per body."""
    raw = _parsed(raw, body, TRAFFIC_PAYLOAD_SCHEMA)
    ok = F.col("__ok")
    f = F.col("__p")["flowSegmentData"]
    d = defaults
    out = raw.select(
        "poll_id",
        _stamp(time_col).alias("timestamp"),
        "city_name", "latitude", "longitude",
        _pick(ok, f["currentSpeed"], d["currentSpeed"]).cast("double").alias("current_speed"),
        _pick(ok, f["freeFlowSpeed"], d["freeFlowSpeed"]).cast("double").alias("free_flow_speed"),
        _pick(ok, f["currentTravelTime"], d["currentTravelTime"]).cast("int").alias("current_travel_time"),
        _pick(ok, f["freeFlowTravelTime"], d["freeFlowTravelTime"]).cast("int").alias("free_flow_travel_time"),
        _pick(ok, f["confidence"], d["confidence"]).cast("double").alias("confidence"),
        _pick(ok, f["roadClosure"], d["roadClosure"]).cast("boolean").alias("road_closure"),
        F.lit(source).alias("data_source"),
        _error(ok).alias("payload_error"),
    )
    out = out.withColumn("congestion_ratio", congestion_ratio("current_speed", "free_flow_speed"))
    out = out.withColumn("congestion_level",
                         F.when(F.col("payload_error").isNull(), congestion_level("congestion_ratio")))
    return out.select(
        "poll_id", "timestamp", "city_name", "latitude", "longitude", "current_speed", "free_flow_speed",
        "current_travel_time", "free_flow_travel_time", "congestion_ratio", "congestion_level",
        "confidence", "road_closure", "data_source", "payload_error",
    )


def flatten_weather(raw: DataFrame, body: str = "body", time_col: str | None = "fetched_at",
                    defaults: dict = WEATHER_DEFAULTS) -> DataFrame:
    """Current-weather body to typed columns."""
    raw = _parsed(raw, body, WEATHER_PAYLOAD_SCHEMA)
    ok = F.col("__ok")
    p = F.col("__p")
    d = defaults
    return raw.select(
        "city_name", "poll_id", "latitude", "longitude",
        _stamp(time_col).alias("timestamp"),
        _pick(ok, p["main"]["temp"], d["temp"]).cast("double").alias("temperature"),
        _pick(ok, p["main"]["feels_like"], d["feels_like"]).cast("double").alias("feels_like"),
        _pick(ok, p["main"]["humidity"], d["humidity"]).cast("int").alias("humidity"),
        _pick(ok, p["main"]["pressure"], d["pressure"]).cast("int").alias("pressure"),
        _pick(ok, p["wind"]["speed"], d["wind_speed"]).cast("double").alias("wind_speed"),
        _pick(ok, F.get(p["weather"], 0)["main"], d["condition"]).alias("weather_condition"),
        _error(ok).alias("weather_error"),
    )


def flatten_air(raw: DataFrame, body: str = "body", defaults: dict = AIR_DEFAULTS) -> DataFrame:
    """Air-pollution body to typed columns (first list entry)."""
    raw = _parsed(raw, body, AIR_PAYLOAD_SCHEMA)
    ok = F.col("__ok")
    first = F.get(F.col("__p")["list"], 0)
    comp = first["components"]
    d = defaults
    return raw.select(
        "city_name", "poll_id",
        _pick(ok, first["main"]["aqi"], d["aqi"]).cast("int").alias("aqi"),
        *[_pick(ok, comp[c], d[c]).cast("double").alias(c) for c in ("co", "no2", "o3", "so2", "pm2_5", "pm10")],
        _error(ok).alias("air_error"),
    )


def merge_weather_air(weather: DataFrame, air: DataFrame, source: str = WEATHER_SOURCE) -> DataFrame:
    """Both calls of one poll make one weather event (inner join on location and poll id).

    Both sides are keyed by ``(city_name, poll_id)`` and unique per key, so this is a
    one-to-one shuffle join (or a broadcast when one side is small at run time).
    """
    j = weather.join(air, ["city_name", "poll_id"], "inner")
    return j.select(
        "poll_id", "timestamp", "city_name", "latitude", "longitude", "temperature", "feels_like",
        "humidity", "pressure", "wind_speed", "weather_condition", "aqi", "co", "no2", "o3", "so2",
        "pm2_5", "pm10", F.lit(source).alias("data_source"),
        F.coalesce("weather_error", "air_error").alias("payload_error"),
    )
