"""Reference SQL (DuckDB dialect) for the registered queries.

Each query is rebuilt from the ``events`` and ``region`` views with the same rules as the
Spark operators: one decimal cast before every rounding, explicit casts to Spark's types, UTC
wall-clock calendar parts, and the same total order for dedup survivors.
"""

from __future__ import annotations

DEC = "DECIMAL(30,12)"


def rhu(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS {DEC}), {n}) AS DOUBLE)"


def rhe(x: str, n: int) -> str:
    return f"CAST(round_even(CAST({x} AS {DEC}), {n}) AS DOUBLE)"


def dbl(v) -> str:
    return f"CAST({v} AS DOUBLE)"


ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def ev_cte(types: tuple[str, ...], name: str, year_shift: int = 0) -> str:
    ts = "e.ts" if not year_shift else f"e.ts + INTERVAL {int(year_shift)} YEAR"
    tlist = ", ".join(f"'{t}'" for t in types)
    return f"""{name} AS (
  SELECT e.event_id, {ts} AS ts, e.user_id, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         r.r_name AS city_name,
         {dbl(19.0)} + r.r_regionkey * {dbl(0.25)} AS latitude,
         {dbl(72.75)} + r.r_regionkey * {dbl(0.125)} AS longitude
  FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5
  WHERE e.event_type IN ({tlist}))"""


def travel_time(speed: str) -> str:
    return f"CAST(round(CAST({dbl(6000.0)} / greatest({speed}, {dbl(1.0)}) AS {DEC}), 0) AS INTEGER)"


def level(ratio: str) -> str:
    return f"CASE WHEN {ratio} >= 0.85 THEN 'Low' WHEN {ratio} >= 0.55 THEN 'Medium' ELSE 'High' END"


def traffic_raw_ctes(with_duplicates: bool = True) -> list[str]:
    dup = ("UNION ALL SELECT *, 1 AS copy FROM t_ev0 WHERE event_id % 10 = 0" if with_duplicates else "")
    return [
        ev_cte(("view", "click", "purchase"), "t_ev"),
        """t_ev0 AS (
  SELECT event_id, ts, city_name, latitude, longitude, k,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN -value ELSE value END AS speed0
  FROM t_ev)""",
        f"""t_ev1 AS (SELECT *, 0 AS copy FROM t_ev0 {dup})""",
        f"""t_ev2 AS (
  SELECT *, speed0 + CAST(copy AS DOUBLE) AS current_speed, CAST(k AS DOUBLE) AS free_flow_speed FROM t_ev1)""",
        f"""t_ev3 AS (
  SELECT *, {rhe(f"current_speed / greatest(free_flow_speed, {dbl(1.0)})", 3)} AS congestion_ratio FROM t_ev2)""",
        f"""traffic_raw AS (
  SELECT event_id, {ISO} AS "timestamp", city_name, latitude, longitude, current_speed, free_flow_speed,
         {travel_time('current_speed')} AS current_travel_time,
         {travel_time('free_flow_speed')} AS free_flow_travel_time,
         congestion_ratio, {level('congestion_ratio')} AS congestion_level,
         {dbl(1.0)} - CAST(event_id % 4 AS DOUBLE) * {dbl(0.25)} AS confidence,
         (event_id % 50 = 0) AS road_closure, 'events' AS data_source,
         ts + to_minutes(copy) AS ingestion_timestamp
  FROM t_ev3)""",
    ]


CONDITIONS = ("Thunderstorm", "Rain", "Clouds", "Haze", "Mist", "Snow", "Drizzle", None, "Clear")


def condition_case(col: str = "event_id % 9") -> str:
    whens = " ".join(f"WHEN {i} THEN {('NULL' if c is None else repr(c))}" for i, c in enumerate(CONDITIONS))
    return f"CASE {col} {whens} END"


def weather_raw_ctes(year_shift: int = 0) -> list[str]:
    temp = f"CAST(k AS DOUBLE) * {dbl(1.3)} - {dbl(55.0)}"
    pm = f"value - {dbl(5.0)}"
    return [
        ev_cte(("signup", "error"), "w_ev", year_shift),
        f"""weather_raw AS (
  SELECT event_id, {ISO} AS "timestamp", city_name, latitude, longitude,
         {temp} AS temperature, ({temp}) - {dbl(1.0)} AS feels_like,
         CAST(event_id % 111 AS INTEGER) AS humidity, CAST(1005 + event_id % 16 AS INTEGER) AS pressure,
         CAST(user_id % 15 AS DOUBLE) AS wind_speed, {condition_case()} AS weather_condition,
         CAST(event_id % 7 AS INTEGER) AS aqi,
         CAST(200 + k AS DOUBLE) AS co, CAST(10 + k % 50 AS DOUBLE) AS no2,
         CAST(20 + k % 70 AS DOUBLE) AS o3, CAST(2 + k % 13 AS DOUBLE) AS so2,
         {pm} AS pm2_5, ({pm}) * {dbl(1.5)} AS pm10, 'events' AS data_source, ts AS ingestion_timestamp
  FROM w_ev)""",
    ]


def temporal_select(src: str) -> str:
    """Calendar parts of the UTC wall-clock time of the parsed ISO text."""
    return f"""SELECT *, CAST(hour(et) AS INTEGER) AS hour, CAST(dayofweek(et) + 1 AS INTEGER) AS day_of_week,
         CAST(day(et) AS INTEGER) AS day_of_month, CAST(month(et) AS INTEGER) AS month,
         CAST(year(et) AS INTEGER) AS year,
         CASE WHEN dayofweek(et) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT *, timezone('UTC', TRY_CAST("timestamp" AS TIMESTAMPTZ)) AS et FROM {src})"""


TRAFFIC_RULES_SQL = ("city_name IS NOT NULL AND \"timestamp\" IS NOT NULL AND current_speed IS NOT NULL "
                     "AND free_flow_speed IS NOT NULL AND current_speed >= 0 AND free_flow_speed > 0")
WEATHER_RULES_SQL = ("city_name IS NOT NULL AND \"timestamp\" IS NOT NULL AND temperature IS NOT NULL "
                     "AND aqi IS NOT NULL AND temperature >= -50 AND temperature <= 60 "
                     "AND humidity >= 0 AND humidity <= 100 AND aqi >= 1 AND aqi <= 5 AND pm2_5 >= 0")

FIRST_INGESTED_SQL = "ingestion_timestamp ASC NULLS LAST, event_id ASC NULLS LAST"


def dedup_cte(name: str, src: str, keys: str, order: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (__rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS __rn FROM {src})
  WHERE __rn = 1)"""


def silver_traffic_ctes() -> list[str]:
    return traffic_raw_ctes() + [
        dedup_cte("t_dedup", "traffic_raw", 'city_name, "timestamp"', FIRST_INGESTED_SQL),
        f"t_clean AS (SELECT * FROM t_dedup WHERE {TRAFFIC_RULES_SQL})",
        f"silver_traffic AS ({temporal_select('t_clean')})",
    ]


def silver_weather_ctes(year_shift: int = 0) -> list[str]:
    return weather_raw_ctes(year_shift) + [
        dedup_cte("w_dedup", "weather_raw", 'city_name, "timestamp"', FIRST_INGESTED_SQL),
        f"w_clean AS (SELECT * FROM w_dedup WHERE {WEATHER_RULES_SQL})",
        f"silver_weather AS ({temporal_select('w_clean')})",
    ]


WEATHER_MEASURES = ("temperature", "humidity", "weather_condition", "wind_speed", "aqi",
                    "pm2_5", "pm10", "co", "no2")
W_KEYS = "w_city, w_year, w_month, w_day, w_hour"


def hourly_weather_cte() -> str:
    m = ", ".join(WEATHER_MEASURES)
    return f"""w_hourly AS (
  SELECT {W_KEYS}, {m} FROM (
    SELECT city_name AS w_city, year AS w_year, month AS w_month, day_of_month AS w_day, hour AS w_hour,
           {m}, row_number() OVER (PARTITION BY city_name, year, month, day_of_month, hour
                                  ORDER BY et DESC NULLS LAST, event_id DESC NULLS LAST) AS __rn
    FROM silver_weather)
  WHERE __rn = 1)"""


def joined_ctes() -> list[str]:
    """J1 with the global J2 fallback (used only when J1 is empty everywhere)."""
    m = ", ".join(f"w.{c}" for c in WEATHER_MEASURES)
    return [
        hourly_weather_cte(),
        f"""j1 AS (
  SELECT t.*, {m} FROM silver_traffic t JOIN w_hourly w
    ON t.city_name = w.w_city AND t.year = w.w_year AND t.month = w.w_month
   AND t.day_of_month = w.w_day AND t.hour = w.w_hour)""",
        f"""w_latest AS (
  SELECT * EXCLUDE (__rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY w_city
              ORDER BY w_year DESC NULLS LAST, w_month DESC NULLS LAST, w_day DESC NULLS LAST,
                       w_hour DESC NULLS LAST) AS __rn FROM w_hourly)
  WHERE __rn = 1)""",
        f"""j2 AS (
  SELECT t.*, {m} FROM silver_traffic t LEFT JOIN w_latest w ON t.city_name = w.w_city)""",
        """joined AS (
  SELECT * FROM j1
  UNION ALL
  SELECT * FROM j2 WHERE NOT EXISTS (SELECT 1 FROM j1))""",
    ]


def gold_mart_ctes() -> list[str]:
    """J1 with fallback and the mart features over CTEs named silver_traffic / silver_weather."""
    return joined_ctes() + [
        f"""mart AS (
  SELECT * REPLACE (coalesce(temperature, {dbl(25.0)}) AS temperature, coalesce(humidity, 70) AS humidity,
                    coalesce(weather_condition, 'Clear') AS weather_condition, coalesce(aqi, 2) AS aqi,
                    coalesce(pm2_5, {dbl(15.0)}) AS pm2_5),
         CASE WHEN coalesce(weather_condition, 'Clear') IN ('Thunderstorm', 'Snow', 'Heavy Rain') THEN 3
              WHEN coalesce(weather_condition, 'Clear') IN ('Rain', 'Drizzle', 'Fog', 'Mist') THEN 2
              WHEN coalesce(weather_condition, 'Clear') IN ('Clouds', 'Haze') THEN 1 ELSE 0 END AS weather_severity_index,
         {rhu('current_speed / free_flow_speed', 4)} AS speed_ratio,
         greatest(0, current_travel_time - free_flow_travel_time) AS delay_time_seconds
  FROM joined)""",
    ]


def mart_ctes(year_shift: int = 0) -> list[str]:
    return silver_traffic_ctes() + silver_weather_ctes(year_shift) + gold_mart_ctes()


KPI_AVERAGES = (
    ("avg_current_speed", "current_speed", 2),
    ("avg_free_flow_speed", "free_flow_speed", 2),
    ("avg_congestion_ratio", "congestion_ratio", 4),
    ("avg_temperature", "temperature", 2),
    ("avg_humidity", "humidity", 2),
    ("avg_aqi", "aqi", 2),
    ("avg_pm2_5", "pm2_5", 2),
)


def kpi_cte() -> str:
    aggs = ", ".join(f"{rhu(f'avg({src})', d)} AS {name}" for name, src, d in KPI_AVERAGES)
    return f"""kpi AS (
  SELECT city_name, hour, is_weekend, congestion_level, {aggs}, count(*) AS total_observations
  FROM mart GROUP BY city_name, hour, is_weekend, congestion_level)"""


def kpi_ctes() -> list[str]:
    aggs = ", ".join(f"{rhu(f'avg({src})', d)} AS {name}" for name, src, d in KPI_AVERAGES)
    return mart_ctes() + [f"""kpi AS (
  SELECT city_name, hour, is_weekend, congestion_level, {aggs}, count(*) AS total_observations
  FROM mart GROUP BY city_name, hour, is_weekend, congestion_level)"""]


def with_query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def cols(names) -> str:
    return ", ".join(f'"{c}"' for c in names)


# ---------------------------------------------------------------------------------------------
# Per-query SQL. Column lists mirror strata.plans.driver.

TRAFFIC_COLS = ["event_id", "timestamp", "city_name", "latitude", "longitude", "current_speed",
                "free_flow_speed", "current_travel_time", "free_flow_travel_time", "congestion_ratio",
                "congestion_level", "confidence", "road_closure", "data_source", "ingestion_timestamp"]
WEATHER_COLS = ["event_id", "timestamp", "city_name", "latitude", "longitude", "temperature",
                "feels_like", "humidity", "pressure", "wind_speed", "weather_condition", "aqi", "co",
                "no2", "o3", "so2", "pm2_5", "pm10", "data_source", "ingestion_timestamp"]
CAL_COLS = ["hour", "day_of_week", "day_of_month", "month", "year", "is_weekend"]
JOIN_COLS = ["event_id", "timestamp", "city_name", "year", "month", "day_of_month", "hour",
             "is_weekend", "current_speed", "free_flow_speed", "congestion_level", *WEATHER_MEASURES]
MART_COLS = TRAFFIC_COLS + CAL_COLS + list(WEATHER_MEASURES) + [
    "weather_severity_index", "speed_ratio", "delay_time_seconds"]
KPI_COLS = ["city_name", "hour", "is_weekend", "congestion_level",
            *[n for n, _, _ in KPI_AVERAGES], "total_observations"]


def _accounting_sql(feed: str, raw: str, rules: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN NOT coalesce({cond}, false) THEN '{name}'" for name, cond in rules)
    p = feed[0]
    return [
        dedup_cte(f"{p}_surv", raw, 'city_name, "timestamp"', FIRST_INGESTED_SQL),
        f"{p}_class AS (SELECT CASE {whens} ELSE 'output' END AS outcome FROM {p}_surv)",
        f"""{p}_acc AS (
  SELECT '{feed}' AS feed, 'input' AS outcome, (SELECT count(*) FROM {raw}) AS "rows"
  UNION ALL SELECT '{feed}', 'duplicate', (SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {p}_surv)
  UNION ALL SELECT '{feed}', outcome, count(*) FROM {p}_class GROUP BY outcome)""",
    ]


TRAFFIC_RULES = [
    ("required:city_name", "city_name IS NOT NULL"),
    ("required:timestamp", '"timestamp" IS NOT NULL'),
    ("required:current_speed", "current_speed IS NOT NULL"),
    ("required:free_flow_speed", "free_flow_speed IS NOT NULL"),
    ("current_speed>=0.0", "current_speed >= 0"),
    ("free_flow_speed>0.0", "free_flow_speed > 0"),
]
WEATHER_RULES = [
    ("required:city_name", "city_name IS NOT NULL"),
    ("required:timestamp", '"timestamp" IS NOT NULL'),
    ("required:temperature", "temperature IS NOT NULL"),
    ("required:aqi", "aqi IS NOT NULL"),
    ("temperature in [-50.0,60.0]", "(temperature >= -50 AND temperature <= 60)"),
    ("humidity in [0,100]", "(humidity >= 0 AND humidity <= 100)"),
    ("aqi in [1,5]", "(aqi >= 1 AND aqi <= 5)"),
    ("pm2_5>=0.0", "pm2_5 >= 0"),
]


def base_oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_temporal"] = with_query(
        weather_raw_ctes() + [f"p AS ({temporal_select('weather_raw')})"],
        f"SELECT event_id, \"timestamp\", city_name, {cols(CAL_COLS)} FROM p")
    q["dedup_events"] = with_query(
        traffic_raw_ctes() + [dedup_cte("d", "traffic_raw", 'city_name, "timestamp"', FIRST_INGESTED_SQL)],
        'SELECT event_id, city_name, "timestamp", current_speed, ingestion_timestamp FROM d')
    q["quality_traffic"] = with_query(
        traffic_raw_ctes(), f"SELECT {cols(TRAFFIC_COLS)} FROM traffic_raw WHERE {TRAFFIC_RULES_SQL}")
    q["quality_weather"] = with_query(
        weather_raw_ctes(), f"SELECT {cols(WEATHER_COLS)} FROM weather_raw WHERE {WEATHER_RULES_SQL}")
    q["row_accounting"] = with_query(
        traffic_raw_ctes() + weather_raw_ctes()
        + _accounting_sql("traffic", "traffic_raw", TRAFFIC_RULES)
        + _accounting_sql("weather", "weather_raw", WEATHER_RULES),
        'SELECT feed, outcome, CAST("rows" AS BIGINT) AS "rows" FROM t_acc '
        'UNION ALL SELECT feed, outcome, CAST("rows" AS BIGINT) FROM w_acc')
    q["silver_traffic"] = with_query(
        silver_traffic_ctes(), f"SELECT {cols(TRAFFIC_COLS + CAL_COLS)}, 'Silver' AS data_layer FROM silver_traffic")
    q["silver_weather"] = with_query(
        silver_weather_ctes(), f"SELECT {cols(WEATHER_COLS + CAL_COLS)}, 'Silver' AS data_layer FROM silver_weather")
    q["hourly_weather"] = with_query(
        silver_weather_ctes() + [hourly_weather_cte()], f"SELECT {W_KEYS}, {', '.join(WEATHER_MEASURES)} FROM w_hourly")
    q["hourly_join"] = with_query(
        silver_traffic_ctes() + silver_weather_ctes() + joined_ctes(), f"SELECT {cols(JOIN_COLS)} FROM j1")
    q["fallback_join"] = with_query(
        silver_traffic_ctes() + silver_weather_ctes(year_shift=1) + joined_ctes(),
        f"SELECT {cols(JOIN_COLS)} FROM joined")
    q["feature_mart"] = with_query(mart_ctes(), f"SELECT {cols(MART_COLS)}, 'Gold' AS data_layer FROM mart")
    q["kpi_rollup"] = with_query(kpi_ctes(), f"SELECT {cols(KPI_COLS)} FROM kpi")
    return q


def _measures_select(by: str) -> str:
    m1 = "avg(avg_congestion_ratio)"
    num = [
        (rhu(m1, 6), "avg_congestion_ratio"),
        (rhu("avg(avg_current_speed)", 6), "avg_current_speed"),
        (rhu("avg(avg_free_flow_speed)", 6), "avg_free_flow_speed"),
        (rhu(f"({dbl(1.0)} - {m1}) * {dbl(100.0)}", 6), "congestion_index_pct"),
        (rhu("avg(CASE WHEN hour IN (8, 9, 17, 18, 19) THEN avg_congestion_ratio END)", 6), "peak_hour_congestion"),
        (rhu("avg(avg_aqi)", 6), "average_aqi"),
        (rhu("avg(avg_pm2_5)", 6), "average_pm2_5"),
    ]
    risk = ("CASE WHEN count(*) = 0 THEN NULL WHEN avg(avg_temperature) > 35 THEN 'Extreme Heat' "
            "WHEN avg(avg_aqi) >= 4 THEN 'Hazardous Air Quality' "
            f"WHEN {m1} < 0.65 THEN 'Heavy Congestion Delay' ELSE 'Optimal Traffic Flow' END")
    sel = ", ".join(f"{e} AS {n}" for e, n in num) + f", {risk} AS weather_risk_level"
    if by:
        return f"SELECT {by}, {sel} FROM kpi GROUP BY {by}"
    return f"SELECT {sel} FROM kpi"


LOC_DIM_CTE = f"""loc_dim AS (
  SELECT lower(r_name) AS name, 'region' AS area_type,
         {dbl(19.0)} + r_regionkey * {dbl(0.25)} AS lat, {dbl(72.75)} + r_regionkey * {dbl(0.125)} AS lon,
         CAST(12 + r_regionkey % 3 AS INTEGER) AS zoom
  FROM region)"""


def _decision_sql() -> str:
    loc = "city_name"
    a1 = ("'⚠️ Heavy congestion expected in ' || city_name || ' during the next hour. (Predicted Speed: ' "
          "|| CAST(predicted_speed AS VARCHAR) || ' km/h)'")
    a2 = "'🚨 Peak traffic rush hour active in ' || city_name || '.'"
    a3 = "'😷 Poor AQI predicted in ' || city_name || ' (AQI Level: ' || CAST(predicted_aqi AS VARCHAR) || ').'"
    a4 = ("'🌧️ Adverse weather (' || weather_condition || ') likely to increase travel times in ' "
          "|| city_name || ' by 25-40%.'")
    r1 = "'Consider alternative routes via Western/Eastern Express Highway to bypass ' || city_name || '.'"
    r2 = "'Traffic flow in ' || city_name || ' is currently near optimal speed.'"
    r3 = "'Air quality alert: Sensitive groups should limit outdoor activity in this zone.'"
    normal = f"'✅ Traffic and environmental metrics normal in ' || {loc} || '.'"
    ctes = mart_ctes() + [
        f"""pred AS (
  SELECT city_name, hour, {rhu('avg(current_speed)', 1)} AS predicted_speed, {rhu('avg(aqi)', 1)} AS predicted_aqi
  FROM mart GROUP BY city_name, hour)""",
        f"""s AS (
  SELECT m.*, p.predicted_speed, p.predicted_aqi,
         {rhe(f"(m.current_speed - p.predicted_speed) / greatest(m.current_speed, {dbl(1.0)}) * {dbl(100.0)}", 1)} AS speed_drop_percent
  FROM mart m JOIN pred p ON m.city_name = p.city_name AND m.hour = p.hour)""",
        """f AS (
  SELECT *, coalesce(predicted_speed < 15 OR speed_drop_percent > 20, false) AS heavy,
         coalesce(hour BETWEEN 8 AND 10 OR hour BETWEEN 17 AND 20, false) AS peak,
         coalesce(predicted_aqi >= 3.5 OR aqi >= 4, false) AS poor,
         coalesce(lower(weather_condition) IN ('rain', 'thunderstorm', 'drizzle', 'mist'), false) AS adverse
  FROM s)""",
        f"""a AS (
  SELECT *, CASE WHEN heavy THEN {a1} END AS a1, CASE WHEN peak THEN {a2} END AS a2,
         CASE WHEN poor THEN {a3} END AS a3, CASE WHEN adverse THEN {a4} END AS a4,
         CASE WHEN heavy THEN {r1} END AS r1, CASE WHEN NOT peak THEN {r2} END AS r2,
         CASE WHEN poor THEN {r3} END AS r3
  FROM f)""",
    ]
    return with_query(ctes, f"""SELECT event_id, city_name, hour, predicted_speed, predicted_aqi, speed_drop_percent,
       coalesce(a1, a2, a3, a4, {normal}) AS primary_alert,
       concat_ws(' | ', a1, a2, a3, a4) AS alerts_text,
       concat_ws(' | ', r1, r2, r3) AS recommendations_text,
       CASE WHEN peak THEN 'Recommended travel window: Post 8:30 PM or between 1:00 PM - 4:00 PM'
            ELSE 'Optimal travel window: 11:00 AM - 1:30 PM & 9:00 PM - 11:00 PM' END AS recommended_travel_window,
       CAST(heavy AS INTEGER) + CAST(peak AS INTEGER) + CAST(poor AS INTEGER) + CAST(adverse AS INTEGER) AS n_alerts
FROM a""")


def gold_oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["measures_by_location"] = with_query(kpi_ctes(), _measures_select("city_name"))
    q["measures_total"] = with_query(kpi_ctes(), _measures_select(""))
    peak = rhu("avg(CASE WHEN hour IN (8, 9, 17, 18, 19) THEN avg_congestion_ratio END)", 6)
    q["measures_by_location_hour"] = with_query(
        kpi_ctes() + [f"m AS ({_measures_select('city_name, hour')})",
                      f"p AS (SELECT city_name, {peak} AS peak FROM kpi GROUP BY city_name)"],
        "SELECT m.* REPLACE (p.peak AS peak_hour_congestion) FROM m LEFT JOIN p ON m.city_name = p.city_name")
    q["location_enrich"] = with_query(silver_traffic_ctes() + [LOC_DIM_CTE], """SELECT t.event_id, t.city_name,
       d.name AS location_name, d.area_type, d.lat, d.lon, d.zoom
FROM silver_traffic t JOIN loc_dim d ON lower(trim(t.city_name)) = lower(trim(d.name))""")
    q["location_unknown"] = with_query(traffic_raw_ctes() + weather_raw_ctes() + [LOC_DIM_CTE], """SELECT city_name, count(*) AS events
FROM (SELECT city_name FROM traffic_raw UNION ALL SELECT city_name FROM weather_raw) n
WHERE NOT EXISTS (SELECT 1 FROM loc_dim d WHERE d.name <> 'asia' AND lower(trim(d.name)) = lower(trim(n.city_name)))
GROUP BY city_name""")
    q["decision_alerts"] = _decision_sql()
    return q


FLAT_TRAFFIC_COLS = ["poll_id", "timestamp", "city_name", "latitude", "longitude", "current_speed",
                     "free_flow_speed", "current_travel_time", "free_flow_travel_time", "congestion_ratio",
                     "congestion_level", "confidence", "road_closure", "data_source", "payload_error"]
FLAT_WEATHER_COLS = ["poll_id", "timestamp", "city_name", "latitude", "longitude", "temperature",
                     "feels_like", "humidity", "pressure", "wind_speed", "weather_condition", "aqi", "co",
                     "no2", "o3", "so2", "pm2_5", "pm10", "data_source", "payload_error"]
BROKEN = "event_id % 101 = 0"
ABSENT = "event_id % 13 = 0"


def _b(expr: str, absent_default: str | None = None) -> str:
    """Null for bodies that are not JSON; the preset default where the field was left out."""
    if absent_default is None:
        return f"CASE WHEN {BROKEN} THEN NULL ELSE {expr} END"
    return f"CASE WHEN {BROKEN} THEN NULL WHEN {ABSENT} THEN {absent_default} ELSE {expr} END"


def flat_traffic_ctes() -> list[str]:
    return [
        ev_cte(("view", "click", "purchase"), "ft_ev"),
        f"""ft0 AS (
  SELECT event_id AS poll_id, {ISO} AS "timestamp", city_name, latitude, longitude,
         {_b('value', dbl(0.0))} AS current_speed,
         {_b('CAST(k AS DOUBLE)')} AS free_flow_speed,
         {_b(travel_time('value'))} AS current_travel_time,
         {_b(travel_time('CAST(k AS DOUBLE)'))} AS free_flow_travel_time,
         {_b(f"{dbl(1.0)} - CAST(event_id % 4 AS DOUBLE) * {dbl(0.25)}", dbl(1.0))} AS confidence,
         {_b('(event_id % 50 = 0)')} AS road_closure,
         'TomTom_API' AS data_source,
         CASE WHEN {BROKEN} THEN 'unparsable body' END AS payload_error
  FROM ft_ev)""",
        f"""flat_traffic AS (
  SELECT *, {rhe(f"current_speed / greatest(free_flow_speed, {dbl(1.0)})", 3)} AS congestion_ratio
  FROM ft0)""",
    ]


def flat_traffic_select() -> str:
    c = [x if x != "congestion_level" else
         f"CASE WHEN payload_error IS NULL THEN {level('congestion_ratio')} END AS congestion_level"
         for x in FLAT_TRAFFIC_COLS]
    return "SELECT " + ", ".join(x if " AS " in x else f'"{x}"' for x in c) + " FROM flat_traffic"


def flat_weather_ctes() -> list[str]:
    temp = f"CAST(k AS DOUBLE) * {dbl(1.3)} - {dbl(55.0)}"
    pm = f"value - {dbl(5.0)}"
    cond = f"coalesce({condition_case()}, 'Clear')"
    return [
        ev_cte(("signup", "error"), "fw_ev"),
        f"""flat_weather AS (
  SELECT event_id AS poll_id, {ISO} AS "timestamp", city_name, latitude, longitude,
         {_b(temp)} AS temperature, {_b(f"({temp}) - {dbl(1.0)}")} AS feels_like,
         {_b('CAST(event_id % 111 AS INTEGER)', '50')} AS humidity,
         {_b('CAST(1005 + event_id % 16 AS INTEGER)')} AS pressure,
         {_b('CAST(user_id % 15 AS DOUBLE)', dbl(3.5))} AS wind_speed,
         {_b(cond, "'Clear'")} AS weather_condition,
         {_b('CAST(event_id % 7 AS INTEGER)', '2')} AS aqi,
         {_b('CAST(200 + k AS DOUBLE)')} AS co, {_b('CAST(10 + k % 50 AS DOUBLE)')} AS no2,
         {_b('CAST(20 + k % 70 AS DOUBLE)')} AS o3, {_b('CAST(2 + k % 13 AS DOUBLE)')} AS so2,
         {_b(pm, dbl(15.0))} AS pm2_5, {_b(f"({pm}) * {dbl(1.5)}")} AS pm10,
         'OpenWeather_API' AS data_source,
         CASE WHEN {BROKEN} THEN 'unparsable body' END AS payload_error
  FROM fw_ev)""",
    ]


def sink_oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flatten_raw_traffic"] = with_query(flat_traffic_ctes(), flat_traffic_select())
    q["flatten_raw_weather_aqi"] = with_query(flat_weather_ctes(), f"SELECT {cols(FLAT_WEATHER_COLS)} FROM flat_weather")
    q["bronze_metadata"] = with_query(
        flat_traffic_ctes() + [f"ft AS ({flat_traffic_select()})"], "SELECT *, 'Bronze' AS data_layer FROM ft")
    q["publish_events"] = with_query(flat_traffic_ctes() + flat_weather_ctes(), """SELECT 'traffic-raw-events' AS topic, city_name AS "key", poll_id, "timestamp" FROM flat_traffic
UNION ALL SELECT 'weather-raw-events', city_name, poll_id, "timestamp" FROM flat_weather
UNION ALL SELECT 'aqi-raw-events', city_name, poll_id, "timestamp" FROM flat_weather""")
    q["csv_roundtrip"] = with_query(kpi_ctes(), f"SELECT {cols(KPI_COLS)} FROM kpi")
    q["layer_publish_rows"] = with_query(
        silver_weather_ctes(), 'SELECT city_name, count(*) AS "rows" FROM silver_weather GROUP BY city_name')
    q["landing_roundtrip"] = q["topic_bronze"] = q["flatten_raw_traffic"]
    q["layer_publish"] = with_query(silver_traffic_ctes(), """
SELECT 'silver/traffic' AS layer, publish, CASE publish WHEN 1 THEN 'all' WHEN 2 THEN 'none' ELSE 'some' END AS uploaded,
       true AS adds_up, (SELECT count(*) FROM silver_traffic
                         WHERE publish < 3 OR city_name <> 'ASIA' OR hour < 12) AS "rows"
FROM (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS publish)""")
    q["object_manifest"] = with_query(
        silver_weather_ctes(), 'SELECT city_name AS "partition", count(*) AS "rows", CAST(0 AS BIGINT) AS wrong_files '
                               'FROM silver_weather GROUP BY city_name')
    return q


def all_oracle() -> dict[str, str]:
    return {**base_oracle(), **gold_oracle(), **sink_oracle(), **stream_oracle(), **job_oracle(), **model_oracle()}


SPEED_FEATURES = ("avg_current_speed", "avg_free_flow_speed", "avg_temperature", "avg_humidity", "avg_aqi", "hour",
                  "day_of_week")


def feature_ctes() -> list[str]:
    """KPI rows with the defaults and fills of the speed model, and the set each falls in."""
    key = " || '|' || ".join(["'42'"] + [f"coalesce(CAST({c} AS VARCHAR), '')"
                                         for c in ("city_name", "hour", "is_weekend", "congestion_level")])
    fills = ", ".join(f"coalesce({c}, {dbl(20.0)}) AS {c}" for c in SPEED_FEATURES[:5])
    return kpi_ctes() + [f"""features AS (
  SELECT * REPLACE ({fills}), {dbl(1013.0)} AS avg_pressure, {dbl(4.2)} AS avg_wind_speed, 3 AS day_of_week,
         CASE WHEN CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS part
  FROM kpi)"""]


def scored_ctes() -> list[str]:
    """Mart rows with the location-hour averages as predictions."""
    return mart_ctes() + [f"""pred AS (
  SELECT city_name, hour, {rhu('avg(current_speed)', 1)} AS predicted_speed, {rhu('avg(aqi)', 1)} AS predicted_aqi
  FROM mart GROUP BY city_name, hour)""",
        "scored AS (SELECT mart.*, predicted_speed, predicted_aqi FROM mart JOIN pred USING (city_name, hour))"]


def model_oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["feature_rows"] = with_query(feature_ctes(), "SELECT city_name, is_weekend, congestion_level, "
                                   f"{cols(SPEED_FEATURES)}, avg_pressure, avg_wind_speed FROM features")
    q["split_rows"] = with_query(
        feature_ctes(), "SELECT city_name, hour, is_weekend, congestion_level, part FROM features")
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in SPEED_FEATURES)
    scaled = ", ".join(f"""CASE WHEN coalesce(s_{c}, 0) = 0 THEN {dbl(0.0)}
              ELSE {rhu(f'({c} - m_{c}) / s_{c}', 6)} END AS scaled_{c}""" for c in SPEED_FEATURES)
    q["scaled_features"] = with_query(
        feature_ctes() + [f"stats AS (SELECT {stats} FROM features WHERE part = 'train')"],
        f"SELECT city_name, hour AS clock_hour, is_weekend, congestion_level, {scaled} FROM features, stats")
    index = f"({dbl(1.0)} - predicted_speed / greatest(free_flow_speed, {dbl(1.0)})) * {dbl(100.0)}"
    q["congestion_index"] = with_query(scored_ctes(), f"""
SELECT event_id, predicted_speed, predicted_aqi,
       {rhe(f'greatest({dbl(0.0)}, least({dbl(100.0)}, {index}))', 1)} AS derived_congestion_index FROM scored""")
    q["metrics_check"] = with_query(scored_ctes() + ["""pairs AS (
  SELECT 'speed' AS model, current_speed AS y, predicted_speed AS p FROM scored
  UNION ALL SELECT 'aqi', CAST(aqi AS DOUBLE), predicted_aqi FROM scored)"""], f"""
SELECT model, count(*) AS "rows", {rhu('sqrt(avg((p - y) * (p - y)))', 4)} AS rmse, {rhu('avg(abs(p - y))', 4)} AS mae,
       {rhu('1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))', 4)} AS r2_score
FROM pairs GROUP BY model""")
    q["training_rows"] = with_query(feature_ctes(), """
SELECT model, count(*) FILTER (part = 'train') AS train_rows, count(*) FILTER (part = 'test') AS test_rows
FROM features, (SELECT unnest(['speed', 'aqi']) AS model) GROUP BY model""")
    q["model_roundtrip"] = with_query(kpi_ctes(), 'SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS differing FROM kpi')
    q["node_table_scores"] = with_query(mart_ctes(), """
SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS differing_predicted_speed, CAST(0 AS BIGINT) AS differing_predicted_aqi,
       CAST(0 AS BIGINT) AS differing_derived_congestion_index FROM mart""")
    return q


def moved_ctes() -> list[str]:
    """Silver traffic with one location's first days in one hour, joined to the hourly weather."""
    hot = "city_name = 'ASIA' AND day_of_month <= 20"
    m = ", ".join(f"w.{c}" for c in WEATHER_MEASURES)
    return silver_traffic_ctes() + silver_weather_ctes() + [hourly_weather_cte(), f"""moved AS (
  SELECT * REPLACE (CASE WHEN {hot} THEN 3 ELSE day_of_month END AS day_of_month,
                    CASE WHEN {hot} THEN 1 ELSE month END AS month, CASE WHEN {hot} THEN 5 ELSE hour END AS hour)
  FROM silver_traffic)""", f"""joined AS (
  SELECT t.*, {m} FROM moved t JOIN w_hourly w
    ON t.city_name = w.w_city AND t.year = w.w_year AND t.month = w.w_month
   AND t.day_of_month = w.w_day AND t.hour = w.w_hour)"""]


def stream_oracle() -> dict[str, str]:
    return {
        "hourly_join_hot": with_query(moved_ctes(), f"SELECT {cols(JOIN_COLS)} FROM joined"),
        "kpi_ordered": with_query(kpi_ctes(), """
SELECT city_name, hour, is_weekend, congestion_level, total_observations,
       row_number() OVER (ORDER BY city_name, hour, is_weekend, congestion_level) AS position FROM kpi"""),
        "stream_silver": base_oracle()["silver_traffic"],
        "stream_gold_refresh": with_query(kpi_ctes(), f"SELECT {cols(KPI_COLS)} FROM kpi"),
    }


def payload_kpi_ctes() -> list[str]:
    """Flattened payload events through silver and gold (the events are unique per location
    and timestamp, so the dedup keeps every row)."""
    return flat_traffic_ctes() + flat_weather_ctes() + [
        f"ft AS ({flat_traffic_select()})",
        dedup_cte("ft_dedup", "ft", 'city_name, "timestamp"', "poll_id"),
        f"ft_clean AS (SELECT * FROM ft_dedup WHERE {TRAFFIC_RULES_SQL})",
        f"silver_traffic AS ({temporal_select('ft_clean')})",
        dedup_cte("fw_dedup", "flat_weather", 'city_name, "timestamp"', "poll_id"),
        f"fw_clean AS (SELECT *, poll_id AS event_id FROM fw_dedup WHERE {WEATHER_RULES_SQL})",
        f"silver_weather AS ({temporal_select('fw_clean')})",
    ] + gold_mart_ctes() + [kpi_cte()]


def job_oracle() -> dict[str, str]:
    return {
        "medallion_files": with_query(kpi_ctes(), f"SELECT {cols(KPI_COLS)} FROM kpi"),
        "medallion_rerun_without_landing": with_query(kpi_ctes(), f"SELECT {cols(KPI_COLS)} FROM kpi"),
        "table_counts": with_query(mart_ctes() + [kpi_cte()], """
SELECT 'bronze/traffic-raw-events' AS "table", count(*) AS "rows" FROM traffic_raw
UNION ALL SELECT 'bronze/weather-raw-events', count(*) FROM weather_raw
UNION ALL SELECT 'silver/traffic', count(*) FROM silver_traffic
UNION ALL SELECT 'silver/weather', count(*) FROM silver_weather
UNION ALL SELECT 'gold/feature_mart', count(*) FROM mart
UNION ALL SELECT 'gold/analytics', count(*) FROM kpi"""),
        "medallion_from_payloads": with_query(payload_kpi_ctes(), f"SELECT {cols(KPI_COLS)} FROM kpi"),
    }
