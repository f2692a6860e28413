"""J1 under a hot location-hour, and the J2 gate inside one plan."""

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, skew
from strata.plans import driver
from tests.conftest import rows

KEYS = "city_name string, year int, month int, day_of_month int, hour int"
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def conf(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def sides(spark):
    """Traffic of 40 hours, one of which holds four fifths of it, and two weather rows per hour."""
    n = F.col("id")
    hour = F.when(n % 5 > 0, 3).otherwise(F.pmod(F.xxhash64("id"), F.lit(24))).cast("int")
    traffic = spark.range(0, 60_000, 1, 12).select(
        n.alias("event_id"), F.lit("a").alias("city_name"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
        F.when(n % 5 > 0, 1).otherwise(n % 2 + 1).cast("int").alias("day_of_month"), hour.alias("hour"))
    weather = spark.range(48).select(
        F.lit("a").alias("city_name"), F.lit(2024).alias("year"), F.lit(1).alias("month"),
        (n % 2 + 1).cast("int").alias("day_of_month"), (n / 2).cast("int").alias("hour"),
        *[F.lit("x").alias(m) if m == "weather_condition" else n.cast("double").alias(m)
          for m in gold.WEATHER_MEASURES],
        F.lit("2024-01-01").cast("timestamp").alias("event_timestamp"), n.alias("event_id"))
    return traffic, weather.unionByName(weather)


def test_adaptive_execution_splits_a_hot_hour(spark, conf, sides):
    traffic, weather = sides
    hourly = gold.hourly_weather(weather)
    # as silver leaves it: dealt by event, so that the hot hour comes from many map tasks
    joined = gold.hourly_join(traffic.repartition(12, "event_id"), hourly)
    assert joined.count() == 60_000
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_measured_hot_hours_are_salted(spark, conf, sides):
    traffic, weather = sides
    hourly = gold.hourly_weather(weather)
    hot = skew.hot_keys(traffic.select(*[s for _, s in gold.HOUR_KEYS]), [s for _, s in gold.HOUR_KEYS], 0.1)
    assert [(r.day_of_month, r.hour, r["__parts"]) for r in hot.collect()] == [(1, 3, 9)]
    salted = gold.hourly_join(traffic, hourly, hot_share=0.01)
    plain = gold.hourly_join(traffic, hourly)
    assert rows(salted.select(*plain.columns)) == rows(plain)
    tasks = salted.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in tasks) < 20_000  # 48,000 rows have the hot hour


def test_heavy_hitter_join_keeps_rows_without_a_match(spark):
    large = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string")
    small = spark.createDataFrame([(1, "one"), (3, "three")], "j int, w string")
    left = skew.heavy_hitter_join(large, small, [("j", "k")], "left", share=0.2)
    assert rows(left, "k", "v", "w") == sorted(
        [(1, "x", "one"), (1, "x", "one"), (1, "y", "one"), (2, "z", None), (None, "n", None)],
        key=lambda t: tuple((x is None, str(x)) for x in t))
    semi = skew.heavy_hitter_join(large, small, [("j", "k")], "left_semi", share=0.2)
    assert semi.columns == ["k", "v"] and semi.count() == 3
    with pytest.raises(ValueError):
        skew.heavy_hitter_join(large, small, [("j", "k")], "full")
    assert skew.heavy_hitter_join(large.limit(0), small, [("j", "k")]).count() == 0


def test_building_a_mart_starts_no_job(spark, sf_small):
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "building a plan")
    try:
        driver.feature_mart(spark, sf_small)
        mart = driver.fallback_join(spark, sf_small)
        assert not sc.statusTracker().getJobIdsForGroup("plan-only")
        assert mart.count() > 0 and sc.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
