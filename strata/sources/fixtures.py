"""Fixture feeds derived from the driver's ``events`` and ``region`` tables.

``traffic_raw`` and ``weather_raw`` have the bronze layout of the two sensor feeds. Every value
is a deterministic function of one ``events`` row, so the SQL oracle can build the same rows.
Location = ``r_name`` where ``r_regionkey = user_id % 5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.metrics import congestion_level, congestion_ratio
from strata.functions.rounding import round_half_up
from strata.functions.temporal import iso_utc_text

TRAFFIC_TYPES = ("view", "click", "purchase")
WEATHER_TYPES = ("signup", "error")

# Weather condition by event_id % 9 (index 7 is a missing condition).
CONDITIONS = ("Thunderstorm", "Rain", "Clouds", "Haze", "Mist", "Snow", "Drizzle", None, "Clear")


# The tables' columns, declared, so that no job looks them up while a plan is built.
TABLES = {"events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
          "region": "r_regionkey int, r_name string"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.from_json("props", "k int")["k"]


def located_events(spark: SparkSession, sf_dir: str, event_types, year_shift: int = 0) -> DataFrame:
    """Events of the given types with their location and coordinates.

    The region join is against a 5-row dimension, which the planner broadcasts by size.
    """
    ev = (table(spark, sf_dir, "events")
          .filter(F.col("event_type").isin(*event_types))
          .select("event_id", "ts", "user_id", "value", "props"))
    if year_shift:
        ev = ev.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {int(year_shift)} YEAR"))
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (ev.join(region, (ev.user_id % 5) == region.r_regionkey, "inner")
              .withColumn("city_name", F.col("r_name"))
              .withColumn("latitude", F.lit(19.0) + F.col("r_regionkey") * F.lit(0.25))
              .withColumn("longitude", F.lit(72.75) + F.col("r_regionkey") * F.lit(0.125))
              .withColumn("k", _k()))


def _travel_time(speed: Column) -> Column:
    return round_half_up(F.lit(6000.0) / F.greatest(speed, F.lit(1.0)), 0).cast("int")


def traffic_raw(spark: SparkSession, sf_dir: str, with_duplicates: bool = True,
                generation: int | None = None) -> DataFrame:
    """Bronze-shaped traffic feed; rows with ``event_id % 10 = 0`` arrive twice when
    ``with_duplicates`` (the copy has speed + 1 and an ingestion time one minute later).
    ``generation`` 0 / 1 keeps only the originals / only the late copies."""
    ev = located_events(spark, sf_dir, TRAFFIC_TYPES)
    speed = (F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("double"))
              .when(F.col("event_id") % 89 == 0, -F.col("value"))
              .otherwise(F.col("value")))
    copies = (F.when((F.col("event_id") % 10 == 0) & F.lit(with_duplicates), F.array(F.lit(0), F.lit(1)))
               .otherwise(F.array(F.lit(0))))
    base = ev.select(
        "event_id", "ts", "city_name", "latitude", "longitude",
        speed.alias("speed0"), F.col("k").cast("double").alias("free_flow_speed"),
        F.explode(copies).alias("copy"),
    )
    if generation is not None:
        base = base.filter(F.col("copy") == generation)
    current = F.col("speed0") + F.col("copy").cast("double")
    return (base
            .withColumn("current_speed", current)
            .withColumn("congestion_ratio", congestion_ratio("current_speed", "free_flow_speed"))
            .select(
                "event_id",
                iso_utc_text("ts").alias("timestamp"),
                "city_name", "latitude", "longitude", "current_speed", "free_flow_speed",
                _travel_time(F.col("current_speed")).alias("current_travel_time"),
                _travel_time(F.col("free_flow_speed")).alias("free_flow_travel_time"),
                "congestion_ratio",
                congestion_level("congestion_ratio").alias("congestion_level"),
                (F.lit(1.0) - (F.col("event_id") % 4).cast("double") * F.lit(0.25)).alias("confidence"),
                (F.col("event_id") % 50 == 0).alias("road_closure"),
                F.lit("events").alias("data_source"),
                F.timestamp_add("MINUTE", F.col("copy"), F.col("ts")).alias("ingestion_timestamp"),
            ))


def weather_raw(spark: SparkSession, sf_dir: str, year_shift: int = 0) -> DataFrame:
    """Bronze-shaped weather + air-quality feed (no duplicates)."""
    ev = located_events(spark, sf_dir, WEATHER_TYPES, year_shift=year_shift)
    temperature = F.col("k").cast("double") * F.lit(1.3) - F.lit(55.0)
    pm25 = F.col("value") - F.lit(5.0)
    condition = F.element_at(F.array(*[F.lit(c).cast("string") for c in CONDITIONS]),
                             (F.col("event_id") % 9 + 1).cast("int"))
    return ev.select(
        "event_id",
        iso_utc_text("ts").alias("timestamp"),
        "city_name", "latitude", "longitude",
        temperature.alias("temperature"),
        (temperature - F.lit(1.0)).alias("feels_like"),
        (F.col("event_id") % 111).cast("int").alias("humidity"),
        (F.lit(1005) + F.col("event_id") % 16).cast("int").alias("pressure"),
        (F.col("user_id") % 15).cast("double").alias("wind_speed"),
        condition.alias("weather_condition"),
        (F.col("event_id") % 7).cast("int").alias("aqi"),
        (F.lit(200.0) + F.col("k")).cast("double").alias("co"),
        (F.lit(10.0) + F.col("k") % 50).cast("double").alias("no2"),
        (F.lit(20.0) + F.col("k") % 70).cast("double").alias("o3"),
        (F.lit(2.0) + F.col("k") % 13).cast("double").alias("so2"),
        pm25.alias("pm2_5"),
        (pm25 * F.lit(1.5)).alias("pm10"),
        F.lit("events").alias("data_source"),
        F.col("ts").alias("ingestion_timestamp"),
    )


NOT_JSON = "<html>upstream error</html>"


def _landing(ev: DataFrame, body: Column) -> DataFrame:
    return ev.select("city_name", "latitude", "longitude", F.col("event_id").alias("poll_id"),
                     body.alias("body"), F.col("ts").alias("fetched_at"))


def _absent(value: Column) -> Column:
    """Null (hence left out by ``to_json``) for every 13th event."""
    return F.when(F.col("event_id") % 13 != 0, value)


def _broken(body: Column) -> Column:
    """Every 101st response is not JSON at all."""
    return F.when(F.col("event_id") % 101 == 0, F.lit(NOT_JSON)).otherwise(body)


def raw_traffic_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw traffic responses, one per traffic event (S11 input)."""
    ev = located_events(spark, sf_dir, TRAFFIC_TYPES)
    flow = F.struct(
        _absent(F.col("value")).alias("currentSpeed"),
        F.col("k").cast("double").alias("freeFlowSpeed"),
        _travel_time(F.col("value")).alias("currentTravelTime"),
        _travel_time(F.col("k").cast("double")).alias("freeFlowTravelTime"),
        _absent(F.lit(1.0) - (F.col("event_id") % 4).cast("double") * F.lit(0.25)).alias("confidence"),
        (F.col("event_id") % 50 == 0).alias("roadClosure"),
    )
    return _landing(ev, _broken(F.to_json(F.struct(flow.alias("flowSegmentData")))))


def raw_weather_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw current-weather responses, one per weather event (S12 input)."""
    ev = located_events(spark, sf_dir, WEATHER_TYPES)
    temperature = F.col("k").cast("double") * F.lit(1.3) - F.lit(55.0)
    condition = F.element_at(F.array(*[F.lit(c).cast("string") for c in CONDITIONS]),
                             (F.col("event_id") % 9 + 1).cast("int"))
    main = F.struct(temperature.alias("temp"), (temperature - F.lit(1.0)).alias("feels_like"),
                    _absent((F.col("event_id") % 111).cast("int")).alias("humidity"),
                    (F.lit(1005) + F.col("event_id") % 16).cast("int").alias("pressure"))
    wind = F.struct(_absent((F.col("user_id") % 15).cast("double")).alias("speed"))
    weather = F.when(F.col("event_id") % 13 != 0, F.array(F.struct(condition.alias("main"))))
    body = F.to_json(F.struct(main.alias("main"), wind.alias("wind"), weather.alias("weather")))
    return _landing(ev, _broken(body))


def raw_air_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw air-pollution responses, one per weather event (S13 input)."""
    ev = located_events(spark, sf_dir, WEATHER_TYPES)
    pm25 = F.col("value") - F.lit(5.0)
    comp = F.struct(
        (F.lit(200.0) + F.col("k")).cast("double").alias("co"),
        (F.lit(10.0) + F.col("k") % 50).cast("double").alias("no2"),
        (F.lit(20.0) + F.col("k") % 70).cast("double").alias("o3"),
        (F.lit(2.0) + F.col("k") % 13).cast("double").alias("so2"),
        _absent(pm25).alias("pm2_5"),
        (pm25 * F.lit(1.5)).alias("pm10"),
    )
    entry = F.struct(F.struct(_absent((F.col("event_id") % 7).cast("int")).alias("aqi")).alias("main"),
                     comp.alias("components"))
    body = F.to_json(F.struct(F.array(entry).alias("list")))
    return _landing(ev, _broken(body))
