"""Declared schemas (S3, S4, S11-S13) and layer schemas.

Landing JSON is always read with these schemas: no inference, stable column order and types.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
I = T.IntegerType()
L = T.LongType()
B = T.BooleanType()


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# S3: raw traffic event, 13 fields.
TRAFFIC_FIELDS = [
    ("timestamp", S), ("city_name", S), ("latitude", D), ("longitude", D),
    ("current_speed", D), ("free_flow_speed", D), ("current_travel_time", I),
    ("free_flow_travel_time", I), ("congestion_ratio", D), ("congestion_level", S),
    ("confidence", D), ("road_closure", B), ("data_source", S),
]
TRAFFIC_SCHEMA = _struct(TRAFFIC_FIELDS)

# Raw weather + air quality event, 18 fields.
WEATHER_FIELDS = [
    ("timestamp", S), ("city_name", S), ("latitude", D), ("longitude", D),
    ("temperature", D), ("feels_like", D), ("humidity", I), ("pressure", I),
    ("wind_speed", D), ("weather_condition", S), ("aqi", I), ("co", D), ("no2", D),
    ("o3", D), ("so2", D), ("pm2_5", D), ("pm10", D), ("data_source", S),
]
WEATHER_SCHEMA = _struct(WEATHER_FIELDS)


def traffic_schema() -> T.StructType:
    return TRAFFIC_SCHEMA


def weather_schema() -> T.StructType:
    return WEATHER_SCHEMA


def struct(**fields: T.DataType) -> T.StructType:
    """A schema of nullable fields."""
    return _struct(fields.items())


def with_fields(schema: T.StructType, extra) -> T.StructType:
    """``schema`` plus extra ``(name, type)`` fields at the end."""
    return T.StructType(list(schema.fields) + [T.StructField(n, t, True) for n, t in extra])


# Traffic flow payload. Numbers are read as doubles; integer columns truncate them.
TRAFFIC_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("flowSegmentData", _struct([
        ("currentSpeed", D), ("freeFlowSpeed", D), ("currentTravelTime", D),
        ("freeFlowTravelTime", D), ("confidence", D), ("roadClosure", B),
    ]), True),
])

# Current weather payload.
WEATHER_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("main", _struct([("temp", D), ("feels_like", D), ("humidity", D), ("pressure", D)]), True),
    T.StructField("wind", _struct([("speed", D)]), True),
    T.StructField("weather", T.ArrayType(_struct([("main", S)])), True),
])

# Air pollution payload.
AIR_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("main", _struct([("aqi", D)]), True),
        T.StructField("components", _struct([
            ("co", D), ("no2", D), ("o3", D), ("so2", D), ("pm2_5", D), ("pm10", D),
        ]), True),
    ])), True),
])

# Landing table of raw response bodies (one row per call).
RAW_LANDING_SCHEMA = _struct([
    ("city_name", S), ("latitude", D), ("longitude", D), ("poll_id", L), ("body", S),
])

# Location dimension.
LOCATION_SCHEMA = _struct([("name", S), ("area_type", S), ("lat", D), ("lon", D), ("zoom", I)])

SILVER_EXTRA = [
    ("event_timestamp", T.TimestampType()), ("hour", I), ("day_of_week", I), ("day_of_month", I),
    ("month", I), ("year", I), ("is_weekend", I), ("processed_timestamp", T.TimestampType()),
    ("data_layer", S),
]

# Gold analytics (A1-A3), 12 columns.
ANALYTICS_SCHEMA = _struct([
    ("hour", I), ("is_weekend", I), ("congestion_level", S), ("avg_current_speed", D),
    ("avg_free_flow_speed", D), ("avg_congestion_ratio", D), ("avg_temperature", D),
    ("avg_humidity", D), ("avg_aqi", D), ("avg_pm2_5", D), ("total_observations", L),
    ("city_name", S),
])
