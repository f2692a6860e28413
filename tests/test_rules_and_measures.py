"""BI measures (M1-M8), decision rules (R1-R8) and the location dimension."""

from strata.operators import decisions, locations, measures
from tests.conftest import rows

KPI = ("city_name string, hour int, avg_congestion_ratio double, avg_current_speed double, "
       "avg_free_flow_speed double, avg_temperature double, avg_aqi double, avg_pm2_5 double, total_observations long")


def kpi(spark, data):
    return spark.createDataFrame(data, KPI)


def test_measures_values_and_peak_filter(spark):
    df = kpi(spark, [("A", 8, 0.5, 20.0, 40.0, 30.0, 2.0, 10.0, 1), ("A", 12, 0.9, 36.0, 40.0, 30.0, 2.0, 20.0, 3)])
    r = measures.measures(df).first()
    assert abs(r.avg_congestion_ratio - 0.7) < 1e-12
    assert abs(r.congestion_index_pct - 30.0) < 1e-9
    assert r.peak_hour_congestion == 0.5
    assert r.average_pm2_5 == 15.0
    assert r.weather_risk_level == "Optimal Traffic Flow"
    w = measures.measures(df, weighted=True).first()
    assert abs(w.avg_congestion_ratio - 0.8) < 1e-12


def test_weather_risk_levels(spark):
    cases = [(35.0, 1.0, 0.9, "Optimal Traffic Flow"), (35.1, 5.0, 0.1, "Extreme Heat"),
             (20.0, 4.0, 0.1, "Hazardous Air Quality"), (20.0, 3.9, 0.649, "Heavy Congestion Delay"),
             (20.0, 3.9, 0.65, "Optimal Traffic Flow")]
    df = kpi(spark, [(f"L{i}", 8, ratio, 20.0, 40.0, temp, aqi, 1.0, 1) for i, (temp, aqi, ratio, _) in enumerate(cases)])
    got = dict(rows(measures.measures(df, by=["city_name"]), "city_name", "weather_risk_level"))
    assert got == {f"L{i}": label for i, (_, _, _, label) in enumerate(cases)}


def test_empty_slice_gives_nulls(spark):
    r = measures.measures(kpi(spark, [])).first()
    assert r.avg_congestion_ratio is None and r.congestion_index_pct is None and r.weather_risk_level is None


DEC = ("city_name string, current_speed double, predicted_speed double, aqi int, predicted_aqi double, "
       "weather_condition string, hour int")


def decide(spark, data):
    return {r.city_name: r for r in decisions.recommend(spark.createDataFrame(data, DEC)).collect()}


def test_speed_rules(spark):
    got = decide(spark, [
        ("a", 100.0, 79.96, 1, 1.0, "Clear", 12),   # drop 20.04 -> 20.0: no alert
        ("b", 100.0, 79.94, 1, 1.0, "Clear", 12),   # drop 20.06 -> 20.1: alert
        ("c", 15.0, 15.0, 1, 1.0, "Clear", 12),     # predicted 15: no alert
        ("d", 15.0, 14.9, 1, 1.0, "Clear", 12),     # predicted 14.9: alert
    ])
    assert got["a"].speed_drop_percent == 20.0 and got["a"].alerts == []
    assert got["b"].speed_drop_percent == 20.1 and got["b"].alerts[0].startswith("⚠️ Heavy congestion expected in b")
    assert got["c"].alerts == []
    assert got["d"].alerts == ["⚠️ Heavy congestion expected in d during the next hour. (Predicted Speed: 14.9 km/h)"]
    assert got["d"].recommendations[0] == "Consider alternative routes via Western/Eastern Express Highway to bypass d."
    assert got["a"].primary_alert == "✅ Traffic and environmental metrics normal in a."


def test_peak_hours(spark):
    hours = [7, 8, 10, 11, 16, 17, 20, 21]
    got = decide(spark, [(f"h{h}", 30.0, 30.0, 1, 1.0, "Clear", h) for h in hours])
    peak = {h for h in hours if got[f"h{h}"].recommended_travel_window.startswith("Recommended")}
    assert peak == {8, 10, 17, 20}
    assert got["h8"].alerts == ["🚨 Peak traffic rush hour active in h8."]
    assert got["h7"].recommendations == ["Traffic flow in h7 is currently near optimal speed."]


def test_air_and_weather_rules(spark):
    got = decide(spark, [("p", 30.0, 30.0, 1, 3.5, "RAIN", 12), ("c", 30.0, 30.0, 4, 1.0, "Fog", 12),
                         ("n", 30.0, 30.0, 3, 3.4, None, 12)])
    assert got["p"].alerts == ["😷 Poor AQI predicted in p (AQI Level: 3.5).",
                               "🌧️ Adverse weather (RAIN) likely to increase travel times in p by 25-40%."]
    assert got["c"].alerts == ["😷 Poor AQI predicted in c (AQI Level: 1.0)."]
    assert got["n"].alerts == [] and len(got["n"].recommendations) == 1


def test_location_lookup_is_case_insensitive_and_finds_unknowns(spark):
    dim = locations.location_dim(spark, rows=[("Andheri", "Hub", 19.1, 72.8, 13), ("42", "Numeric", 19.0, 72.9, 12)])
    feed = spark.createDataFrame([("ANDHERI",), ("andheri",), ("42",), ("Atlantis",)], "city_name string")
    enriched = locations.enrich_locations(feed, dim)
    assert rows(enriched, "city_name", "location_name") == [("42", "42"), ("ANDHERI", "Andheri"), ("andheri", "Andheri")]
    assert rows(locations.unknown_locations(feed, dim), "name_seen", "events") == [("Atlantis", 1)]
    assert locations.location_dim(spark).count() == 15


def test_strict_location_lookup_raises_on_unknown_names(spark):
    import pytest
    dim = locations.location_dim(spark)
    ok = spark.createDataFrame([("bkc",), ("Navi Mumbai",)], "city_name string")
    assert locations.require_known_locations(ok, dim) is ok
    bad = spark.createDataFrame([("Atlantis",)], "city_name string")
    with pytest.raises(locations.UnknownLocationError):
        locations.require_known_locations(bad, dim)


def test_peak_measure_ignores_an_hour_slice(spark):
    df = kpi(spark, [("A", 8, 0.5, 20.0, 40.0, 30.0, 2.0, 10.0, 1), ("A", 12, 0.9, 36.0, 40.0, 30.0, 2.0, 20.0, 3),
                     ("A", 17, 0.7, 20.0, 40.0, 30.0, 2.0, 10.0, 1), ("B", 9, 0.2, 20.0, 40.0, 30.0, 2.0, 10.0, 1)])
    by_hour = {(r.city_name, r.hour): r for r in measures.measures(df, by=["city_name", "hour"]).collect()}
    assert by_hour[("A", 12)].peak_hour_congestion == 0.6    # peak hours 8 and 17 of location A
    assert by_hour[("A", 12)].avg_congestion_ratio == 0.9
    assert by_hour[("B", 9)].peak_hour_congestion == 0.2
    only_hour = {r.hour: r.peak_hour_congestion for r in measures.measures(df, by=["hour"]).collect()}
    assert set(only_hour.values()) == {(0.5 + 0.7 + 0.2) / 3}
