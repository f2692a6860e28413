"""Location dimension (S9), case-insensitive lookup (F5) and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import LOCATION_SCHEMA

# The monitored locations of the traffic preset (name, area_type, lat, lon, zoom).
PRESET_LOCATIONS = (
    ("Andheri", "Commercial & Transport Hub", 19.1197, 72.8464, 13),
    ("Bandra", "Commercial & Residential", 19.0596, 72.8295, 13),
    ("BKC", "Financial District", 19.0657, 72.8686, 14),
    ("Powai", "Tech Hub & Residential", 19.1176, 72.9060, 13),
    ("Dadar", "Central Transit Junction", 19.0178, 72.8478, 13),
    ("Kurla", "Transit & Commercial", 19.0726, 72.8845, 13),
    ("Borivali", "Suburban Transit Hub", 19.2307, 72.8567, 13),
    ("Ghatkopar", "Eastern Suburb Junction", 19.0860, 72.9080, 13),
    ("Chembur", "Industrial & Residential", 19.0621, 72.8988, 13),
    ("Lower Parel", "Business Hub", 18.9953, 72.8315, 13),
    ("CST", "Heritage & Railway Terminus", 18.9401, 72.8351, 14),
    ("Marine Drive", "Coastal Highway", 18.9440, 72.8230, 14),
    ("Airport", "International Terminal (CSMIA)", 19.0896, 72.8656, 14),
    ("Thane", "Metropolitan Suburb", 19.2183, 72.9781, 12),
    ("Navi Mumbai", "Planned City Region", 19.0330, 73.0297, 12),
)


def location_dim(spark: SparkSession, path: str | None = None, fmt: str = "csv",
                 rows=PRESET_LOCATIONS) -> DataFrame:
    """The dimension from a file (read with the declared schema, so a numeric-looking name
    stays text) or from inline rows."""
    if path:
        reader = spark.read.schema(LOCATION_SCHEMA)
        if fmt == "csv":
            reader = reader.option("header", True)
        return reader.format(fmt).load(path)
    return spark.createDataFrame(list(rows), LOCATION_SCHEMA)


def _match_key(col: str):
    return F.lower(F.col(col))


def enrich_locations(df: DataFrame, dim: DataFrame, name_col: str = "city_name",
                     how: str = "inner") -> DataFrame:
    """Attach area, coordinates and zoom by case-insensitive name.

    The dimension is one row per location; the planner broadcasts it from its size estimate
    (no hint, so a large dimension falls back to a shuffle join instead of failing).
    """
    d = (dim.groupBy(_match_key("name").alias("__loc_key"))
         .agg(F.min_by(F.struct("name", "area_type", "lat", "lon", "zoom"), "name").alias("__row"))
         .select("__loc_key", F.col("__row.name").alias("location_name"), "__row.area_type",
                 "__row.lat", "__row.lon", "__row.zoom"))
    out = df.withColumn("__loc_key", _match_key(name_col)).join(d, "__loc_key", how)
    return out.drop("__loc_key")


def unknown_locations(df: DataFrame, dim: DataFrame, name_col: str = "city_name") -> DataFrame:
    """names in ``df`` with no dimension entry, with their row counts.

    Counting first (partial aggregation) shrinks the feed to one row per name before the
    anti join.
    """
    names = (df.groupBy(F.col(name_col).alias("name_seen"))
               .agg(F.count(F.lit(1)).alias("events"))
               .withColumn("__loc_key", _match_key("name_seen")))
    d = dim.select(_match_key("name").alias("__loc_key"))
    return names.join(d, "__loc_key", "left_anti").drop("__loc_key")


class UnknownLocationError(ValueError):
    pass


def require_known_locations(df: DataFrame, dim: DataFrame, name_col: str = "city_name",
                            max_listed: int = 20) -> DataFrame:
    """F5, strict form: raise when ``df`` names a location the dimension lacks.

    The error lists the first ``max_listed`` unknown names and says how many there are in all; only these are
    brought to the driver. Returns ``df`` unchanged when every name is known.
    """
    found = unknown_locations(df, dim, name_col).select(F.coalesce("name_seen", F.lit("(null)")).alias("name"))
    total = found.agg(F.count(F.lit(1))).scalar()
    unknown = found.orderBy("name").limit(max_listed).withColumn("total", total).collect()
    if unknown:
        names = [r.name for r in unknown]
        more = unknown[0].total - len(names)
        raise UnknownLocationError(f"locations not configured: {names}" + (f" and {more} more" if more else ""))
    return df
