"""Hourly join, fallback, feature mart and KPI rollup."""

from pyspark.sql import functions as F

from strata.operators import gold
from tests.conftest import rows

TRAFFIC = ("event_id long, city_name string, year int, month int, day_of_month int, hour int, is_weekend int, "
           "current_speed double, free_flow_speed double, current_travel_time int, free_flow_travel_time int, "
           "congestion_ratio double, congestion_level string")
WEATHER = ("event_id long, city_name string, year int, month int, day_of_month int, hour int, "
           "event_timestamp timestamp, temperature double, humidity int, weather_condition string, "
           "wind_speed double, aqi int, pm2_5 double, pm10 double, co double, no2 double")


def traffic(spark, data):
    return spark.createDataFrame(data, TRAFFIC)


def weather(spark, data):
    import datetime as dt
    out = []
    for (eid, city, y, m, d, h, minute, cond) in data:
        out.append((eid, city, y, m, d, h, dt.datetime(y, m, d, h, minute), 20.0 + minute, 60, cond,
                    3.0, 2, 10.0, 15.0, 200.0, 20.0))
    return spark.createDataFrame(out, WEATHER)


def t_row(eid, city, h, day=1, cs=30.0):
    return (eid, city, 2024, 1, day, h, 0, cs, 40.0, 100, 80, cs / 40.0, "Medium")


def test_hourly_weather_keeps_latest_event_of_the_hour(spark):
    w = weather(spark, [(1, "A", 2024, 1, 1, 8, 5, "Rain"), (2, "A", 2024, 1, 1, 8, 50, "Snow"),
                        (3, "A", 2024, 1, 1, 9, 1, "Clear")])
    out = gold.hourly_weather(w)
    assert rows(out, "w_hour", "weather_condition") == [(8, "Snow"), (9, "Clear")]


def test_hourly_join_matches_at_most_once_and_never_adds_rows(spark):
    t = traffic(spark, [t_row(1, "A", 8), t_row(2, "A", 8), t_row(3, "A", 10), t_row(4, "B", 8)])
    w = weather(spark, [(1, "A", 2024, 1, 1, 8, 5, "Rain"), (2, "A", 2024, 1, 1, 8, 50, "Mist")])
    j = gold.join_weather(t, gold.hourly_weather(w), fallback="global")
    assert rows(j, "event_id", "weather_condition") == [(1, "Mist"), (2, "Mist")]
    assert j.count() <= t.count()


def test_global_fallback_only_when_the_hourly_join_is_empty(spark):
    t = traffic(spark, [t_row(1, "A", 8), t_row(2, "B", 8)])
    w = weather(spark, [(1, "A", 2025, 1, 1, 8, 5, "Rain"), (2, "A", 2025, 1, 1, 9, 5, "Haze")])
    hourly = gold.hourly_weather(w)
    j = gold.join_weather(t, hourly, fallback="global")
    # No hourly match anywhere: left join to the latest weather of the location.
    assert rows(j, "event_id", "weather_condition") == [(1, "Haze"), (2, None)]
    assert gold.join_weather(t, hourly, fallback="none").count() == 0


def test_per_row_fallback(spark):
    t = traffic(spark, [t_row(1, "A", 8), t_row(2, "A", 12), t_row(3, "B", 8)])
    w = weather(spark, [(1, "A", 2024, 1, 1, 8, 5, "Rain"), (2, "A", 2024, 1, 1, 9, 5, None)])
    j = gold.join_weather(t, gold.hourly_weather(w), fallback="per_row")
    assert rows(j, "event_id", "weather_condition") == [(1, "Rain"), (2, None), (3, None)]


def test_gold_features_fill_only_listed_columns(spark):
    t = traffic(spark, [t_row(1, "A", 8), t_row(2, "B", 8)])
    w = weather(spark, [(1, "A", 2024, 1, 1, 8, 5, None)])
    mart = gold.add_gold_features(gold.join_weather(t, gold.hourly_weather(w), fallback="per_row"))
    got = {r.event_id: r for r in mart.collect()}
    assert got[1].weather_condition == "Clear" and got[1].weather_severity_index == 0
    assert got[2].temperature == 25.0 and got[2].humidity == 70 and got[2].aqi == 2 and got[2].pm2_5 == 15.0
    assert got[2].wind_speed is None and got[2].pm10 is None
    assert got[1].speed_ratio == 0.75 and got[1].delay_time_seconds == 20


def test_kpi_rollup_groups_pool_days_and_count(spark):
    mart = spark.createDataFrame([
        ("A", 8, 0, "Medium", 30.0, 40.0, 0.75, 20.0, 60, 2, 10.0),
        ("A", 8, 0, "Medium", 31.0, 40.0, 0.775, 21.0, 61, 3, 11.0),   # another day, same clock hour
        ("A", 9, 0, "Low", 40.0, 40.0, 1.0, 22.0, 62, 4, 12.0),
    ], "city_name string, hour int, is_weekend int, congestion_level string, current_speed double, "
       "free_flow_speed double, congestion_ratio double, temperature double, humidity int, aqi int, pm2_5 double")
    kpi = gold.kpi_rollup(mart)
    got = kpi.collect()
    assert [(r.hour, r.total_observations, r.avg_current_speed, r.avg_congestion_ratio, r.avg_aqi) for r in got] == [
        (8, 2, 30.5, 0.7625, 2.5), (9, 1, 40.0, 1.0, 4.0)]
    assert kpi.agg(F.sum("total_observations")).first()[0] == mart.count()
