"""Skew: one key holding a third of the rows must not change results, and the dedup plan
must reduce copies before the shuffle."""

import datetime as dt

from strata.operators import gold, quality, silver
from strata.sources.object_store import s3a_options
from tests.conftest import rows


def test_hot_key_dedup_and_rollup(spark):
    t0 = dt.datetime(2024, 1, 1, 8, 0, 0)
    hot = [(1, "A", "2024-01-01T08:00:00+00:00", 30.0 + (i % 7), 40.0, t0 + dt.timedelta(seconds=i))
           for i in range(20000)]
    cold = [(100 + i, "B", f"2024-01-01T09:{i // 60:02d}:{i % 60:02d}+00:00", 20.0, 40.0, t0) for i in range(40000)]
    df = spark.createDataFrame(hot + cold, "event_id long, city_name string, timestamp string, "
                                           "current_speed double, free_flow_speed double, ingestion_timestamp timestamp_ntz")
    df = df.repartition(8)
    out = quality.dedup(df, silver.EVENT_KEYS, silver.FIRST_INGESTED)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == 1 + 40000
    assert rows(out.filter("city_name = 'A'"), "current_speed") == [(30.0,)]
    mart = df.withColumns({"hour": df.timestamp.substr(12, 2).cast("int"), "is_weekend": df.event_id * 0,
                           "congestion_level": df.city_name, "congestion_ratio": df.current_speed / 40.0,
                           "temperature": df.current_speed, "humidity": (df.event_id * 0).cast("int"),
                           "aqi": (df.event_id * 0 + 2).cast("int"), "pm2_5": df.current_speed})
    kpi = {r.city_name: r.total_observations for r in gold.kpi_rollup(mart).collect()}
    assert kpi == {"A": 20000, "B": 40000}


def test_s3a_options_take_explicit_values_only():
    conf = s3a_options(endpoint="http://object-store:9000", path_style=True)
    assert "spark.hadoop.fs.s3a.access.key" not in conf
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
