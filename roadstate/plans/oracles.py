"""Equivalent SQL of the registered queries, for an independent engine.

Written for the given tables in ANSI style with a few common extensions. Each
text spells the semantics out in its own way; nothing here is run by Spark.
"""

from __future__ import annotations

from roadstate.schemas import CALENDAR, LAGS, MODEL_FEATURES, ROLLING

_D = "::DOUBLE"

EV = f"""ev AS (
  SELECT event_id AS seq, event_type, props, user_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
    ts AS event_ts, CAST(ts AS DATE) AS dt,
    'r' || user_id AS road_name, 'd' || (user_id % 12) AS district, 'c' || (user_id % 3) AS city,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 21.0{_D} + (event_id % 1000) / 10000.0{_D} END AS latitude,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE 105.0{_D} + (event_id % 1000) / 10000.0{_D} END AS longitude,
    event_id % 500 AS vehicle_count,
    value AS avg_speed, value * 0.5{_D} AS min_speed, value * 1.6{_D} AS max_speed,
    round(greatest(0.0{_D}, (25.0{_D} - value) * 0.8{_D}), 2) AS avg_delay_minutes,
    CAST(floor((event_id % 500) * 0.02{_D}) AS BIGINT) AS truck_count,
    CAST(floor((event_id % 500) * 0.03{_D}) AS BIGINT) AS bus_count,
    CAST(floor((event_id % 500) * 0.8{_D}) AS BIGINT) AS motorbike_count,
    CAST(floor((event_id % 500) * 0.1{_D}) AS BIGINT) AS car_count,
    CAST(floor((event_id % 500) * 0.05{_D}) AS BIGINT) AS taxi_count,
    0.02{_D} AS truck_ratio, 0.03{_D} AS bus_ratio, 0.8{_D} AS motorbike_ratio,
    0.1{_D} AS car_ratio, 0.05{_D} AS taxi_ratio,
    CASE WHEN event_type = 'error' THEN CAST(floor(value / 30) AS BIGINT) ELSE 0 END AS accident_count,
    20.0{_D} + event_id % 15 AS temperature_celsius,
    60.0{_D} + event_id % 40 AS humidity_percentage,
    CASE event_id % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Rain' END AS weather_condition,
    CASE WHEN event_id % 4 = 2 THEN 1 ELSE 0 END AS is_rain,
    CAST(hour(ts) AS INTEGER) AS hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_peak_hour,
    event_id + (event_id % 7) * 40 AS arrival
  FROM events)"""

ROUTE = "road_name, district, city"
STATUS = """CASE WHEN accident_count >= 1 THEN 'ACCIDENT'
  WHEN avg_speed < 10 OR avg_delay_minutes >= 10 THEN 'CONGESTED'
  WHEN avg_speed < 20 OR avg_delay_minutes >= 5 THEN 'SLOW' ELSE 'NORMAL' END"""

_latest = ", ".join(
    f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in [
        "latitude", "longitude", "avg_speed", "vehicle_count", "avg_delay_minutes",
        "accident_count", "weather_condition", "is_rain",
    ]
)
STATES = f"""states AS (
  SELECT *, {STATUS} AS road_status FROM (
    SELECT {ROUTE}, {_latest}, max(event_ts) AS last_event_time FROM ev GROUP BY {ROUTE}))"""
_WORST = f"avg_delay_minutes DESC NULLS LAST, avg_speed ASC NULLS LAST, {ROUTE}"
BOARD = f"board AS (SELECT * FROM states ORDER BY {_WORST} LIMIT 500)"  # the report itself only


def _with(*ctes: str, body: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def _lags(order: str, where: str = "") -> str:
    parts = [
        f"CAST(lag({source}, {k}) OVER (PARTITION BY {ROUTE} ORDER BY {order}) AS DOUBLE) AS {prefix}_{k}"
        for source, prefix in LAGS.items()
        for k in (1, 2, 3)
    ]
    return ", ".join(parts)


def _rolling(order: str) -> str:
    frame = f"OVER (PARTITION BY {ROUTE} ORDER BY {order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    means = [f"avg({source}) {frame} AS {name}" for source, name in ROLLING.items()]
    base = f'arg_max(seq, row("timestamp", arrival, seq)) {frame} AS base'
    return ", ".join([*means, base, f"count(*) {frame} AS filled"])


def enriched(order: str, source: str = "ev", name: str = "enriched") -> str:
    """Lags at arrival, then the latest-by-time record of each full window."""
    return (
        f"lagged AS (SELECT *, {_lags(order)} FROM {source}), "
        f"windows AS (SELECT {_rolling(order)} FROM lagged), "
        f"{name} AS (SELECT l.*, w.rolling_avg_speed_3, w.rolling_vehicle_count_3, w.rolling_delay_3 "
        f"FROM windows w JOIN lagged l ON l.seq = w.base WHERE w.filled = 3)"
    )


def chained(order: str, source: str = "filled") -> str:
    """Enriched records with the arrival they were emitted at; an absent accident count is 0."""
    return enriched(order, source).replace(
        f"windows AS (SELECT {_rolling(order)} FROM lagged)",
        f"windows AS (SELECT seq AS emit_seq, {_rolling(order)} FROM lagged)",
    ).replace("SELECT l.*, w.rolling_avg_speed_3", "SELECT l.*, w.emit_seq, w.rolling_avg_speed_3") + (
        ", chain AS (SELECT * REPLACE (coalesce(accident_count, 0) AS accident_count) FROM enriched)"
    )


def near(c: str) -> str:
    """Four decimals, ties and last-bit noise going up in both engines."""
    return f"floor(CAST({c} AS DOUBLE) * 10000.0{_D} + 0.50001{_D}) / 10000.0{_D}"


def r4(*columns: str) -> str:
    return ", ".join(f"{near(c)} AS {c}" for c in columns)


LAG_OUT = [f"{p}_{k}" for p in LAGS.values() for k in (1, 2, 3)]
ROLL_OUT = list(ROLLING.values())


def runs(order: str, speed: str = "10", source: str = "ev") -> str:
    """Gaps and islands: every reset row opens a new island."""
    return f"""flagged AS (
  SELECT *, coalesce(avg_speed, 0) < {speed} AS low, CAST(replace("timestamp", 'T', ' ') AS TIMESTAMP) AS t,
    sum(CASE WHEN coalesce(avg_speed, 0) >= {speed} THEN 1 ELSE 0 END)
      OVER (PARTITION BY {ROUTE} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM {source}),
counted AS (
  SELECT *, row_number() OVER w AS n, first_value(t) OVER w AS t0 FROM flagged WHERE low
  WINDOW w AS (PARTITION BY {ROUTE}, island ORDER BY {order})),
congestion AS (
  SELECT *, trunc((epoch(t) - epoch(t0)) / 60) AS minutes FROM counted
  WHERE n >= 3 OR trunc((epoch(t) - epoch(t0)) / 60) >= 30)"""


CONGESTION_OUT = f"""SELECT seq, 'long_congestion' AS alert_type,
  CASE WHEN avg_speed < 7 THEN 'high' ELSE 'medium' END AS severity, {ROUTE}, "timestamp",
  avg_speed, vehicle_count, CAST(n AS BIGINT) AS low_speed_event_count,
  CAST(greatest(minutes, 0) AS BIGINT) AS low_speed_duration_minutes,
  '3_events_or_30m_avg_speed_lt_10.0' AS rule,
  n >= 3 AS by_events, minutes >= 30 AS by_duration FROM congestion"""


def history(order: str, source: str = "ev") -> str:
    frame = f"OVER (PARTITION BY {ROUTE} ORDER BY {order} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"
    return f"""history AS (
  SELECT *, coalesce(avg(accident_count) {frame}, 0) AS m, coalesce(max(accident_count) {frame}, 0) AS p FROM {source}),
accidents AS (
  SELECT *, accident_count > 0 AND p = 0 AS first_one,
    accident_count > 0 AND accident_count >= greatest(1, m * 3) AS spike, accident_count >= 2 AS multi
  FROM history WHERE (accident_count > 0 AND p = 0)
    OR (accident_count > 0 AND accident_count >= greatest(1, m * 3)) OR accident_count >= 2)"""


ACCIDENT_OUT = f"""SELECT seq, 'accident_anomaly' AS alert_type,
  CASE WHEN accident_count >= 2 THEN 'high' ELSE 'medium' END AS severity, {ROUTE}, "timestamp",
  accident_count, round(m, 3) AS history_avg_accident_count, CAST(p AS BIGINT) AS history_max_accident_count,
  avg_speed, vehicle_count, 'current_gt_0_and_spike_multiplier_3.0' AS rule,
  first_one AS by_first, spike AS by_spike, multi AS by_multi FROM accidents"""

ALERTS = """alerts AS (
  SELECT CAST(replace("timestamp", 'T', ' ') AS TIMESTAMP) AS alert_time, 'congestion' AS alert_category,
    road_name, district, city, CASE WHEN avg_speed < 7 THEN 'high' ELSE 'medium' END AS severity,
    avg_speed, CAST(NULL AS DOUBLE) AS avg_delay_minutes, CAST(NULL AS DOUBLE) AS accident_count,
    'Congestion alert' AS message, 'trafic.congestion_alerts' AS source_topic FROM congestion
  UNION ALL
  SELECT CAST(replace("timestamp", 'T', ' ') AS TIMESTAMP), 'accident', road_name, district, city,
    CASE WHEN accident_count >= 2 THEN 'high' ELSE 'medium' END, avg_speed, NULL, CAST(accident_count AS DOUBLE),
    'Congestion alert', 'trafic.accident_anomaly_alerts' FROM accidents)"""

_RECENT = """SELECT * FROM alerts ORDER BY alert_time DESC, alert_category, road_name, district, city,
  severity, avg_speed NULLS LAST, avg_delay_minutes NULLS LAST, accident_count NULLS LAST LIMIT 300"""

# Variants of alert text: alternative keys, blanks, wrong types. The same text
# is built by Spark from the same expression.
RAW_ALERT = """CASE event_id % 5
  WHEN 0 THEN concat('{"road_name":"r', user_id, '","district":"d', user_id % 12, '","city":"c', user_id % 3,
    '","severity":"high","alert_time":"', {iso}, '","avg_speed":', value, ',"accident_count":', event_id % 4,
    ',"message":"m', event_id % 9, '"}')
  WHEN 1 THEN concat('{"road":"r', user_id, '","level":"low","event_time":"', {iso}, '","avg_speed":"', value,
    '","accident_count":', event_id % 4, '.0,"avg_delay_minutes":', event_id % 20, '}')
  WHEN 2 THEN concat('{"road_name":"","road":"r', user_id, '","district":null,"severity":"","level":"",',
    '"alert_time":"","timestamp":"', {iso}, '","reason":"r', event_id % 9, '","avg_delay_minutes":', value, '}')
  WHEN 3 THEN concat('{"road_name":7,"city":"c', user_id % 3, '","timestamp":"bad","event_time":"', {iso},
    '","accident_count":"3"}')
  ELSE concat('{"event_time":"', {iso}, '","detail":', props, '}') END"""


def _text(path: str) -> str:
    return (
        f"CASE WHEN json_type(raw, '$.{path}') = 'VARCHAR' "
        f"THEN nullif(json_extract_string(raw, '$.{path}'), '') END"
    )


def _double(path: str) -> str:
    return (
        f"CASE WHEN json_type(raw, '$.{path}') IN ('DOUBLE', 'UBIGINT', 'BIGINT') "
        f"THEN CAST(json_extract_string(raw, '$.{path}') AS DOUBLE) END"
    )


def _long(path: str) -> str:
    return (
        f"CASE WHEN json_type(raw, '$.{path}') IN ('UBIGINT', 'BIGINT') "
        f"THEN CAST(json_extract_string(raw, '$.{path}') AS BIGINT) END"
    )


def _time(path: str) -> str:
    return f"TRY_CAST({_text(path)} AS TIMESTAMP)"


def _normalize(category: str) -> str:
    topic = {"congestion": "trafic.congestion_alerts", "accident": "trafic.accident_anomaly_alerts"}[category]
    return f"""SELECT seq, coalesce({_time('alert_time')}, {_time('timestamp')}, {_time('event_time')}) AS alert_time,
  '{category}' AS alert_category, coalesce({_text('road_name')}, {_text('road')}, '') AS road_name,
  coalesce({_text('district')}, '') AS district, coalesce({_text('city')}, '') AS city,
  coalesce({_text('severity')}, {_text('level')}, 'warning') AS severity, {_double('avg_speed')} AS avg_speed,
  {_double('avg_delay_minutes')} AS avg_delay_minutes,
  CAST({_long('accident_count')} AS DOUBLE) AS accident_count,
  coalesce({_text('message')}, {_text('reason')}, 'Congestion alert') AS message, '{topic}' AS source_topic FROM raws"""


# -- long-term features at several cutoffs --------------------------------------

CUTOFFS = ["2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-01-28 12:00:00"]


def longterm(cutoffs: str) -> str:
    """The feature table written with plain joins, for every cutoff in ``cutoffs``."""
    return f"""cutoffs AS ({cutoffs}),
lt_events AS (
  SELECT DISTINCT c.cut, event_ts, {ROUTE}, hour, day_of_week, avg_speed, avg_delay_minutes
  FROM ev JOIN cutoffs c ON event_ts <= c.cut),
lt_slots AS (
  SELECT cut, {ROUTE}, CAST(h.h AS INTEGER) AS hour, CAST(w.w AS INTEGER) AS day_of_week
  FROM (SELECT DISTINCT cut, {ROUTE} FROM lt_events), range(24) h(h), range(7) w(w)),
lt_base AS (
  SELECT cut, {ROUTE}, avg(avg_speed) AS baseline_speed_7d FROM lt_events
  WHERE event_ts >= cut - INTERVAL 7 DAY GROUP BY cut, {ROUTE}),
lt_hour AS (
  SELECT cut, {ROUTE}, hour, day_of_week, avg(avg_speed) AS avg_speed_hour_dow_4w,
    avg(avg_delay_minutes) AS avg_delay_hour_dow_4w FROM lt_events
  WHERE event_ts >= cut - INTERVAL 28 DAY GROUP BY cut, {ROUTE}, hour, day_of_week),
lt_latest AS (
  SELECT cut, {ROUTE}, hour, day_of_week, max(CAST(event_ts AS DATE)) AS latest_date
  FROM lt_events GROUP BY cut, {ROUTE}, hour, day_of_week),
lt_before AS (
  SELECT l.cut, l.road_name, l.district, l.city, l.hour, l.day_of_week,
    avg(e.avg_speed) AS avg_speed_same_hour_yesterday, avg(e.avg_delay_minutes) AS avg_delay_same_hour_yesterday
  FROM lt_latest l LEFT JOIN lt_events e ON e.cut = l.cut AND e.road_name = l.road_name
    AND e.district = l.district AND e.city = l.city AND e.hour = l.hour
    AND CAST(e.event_ts AS DATE) = l.latest_date - 1
  GROUP BY l.cut, l.road_name, l.district, l.city, l.hour, l.day_of_week),
longterm AS (
  SELECT s.road_name, s.district, s.city, s.hour, s.day_of_week, b.baseline_speed_7d,
    h.avg_speed_hour_dow_4w, h.avg_delay_hour_dow_4w, y.avg_delay_same_hour_yesterday,
    y.avg_speed_same_hour_yesterday, s.cut AS source_cutoff, CAST(s.cut AS DATE) AS dt
  FROM lt_slots s LEFT JOIN lt_base b USING (cut, {ROUTE})
  LEFT JOIN lt_hour h USING (cut, {ROUTE}, hour, day_of_week)
  LEFT JOIN lt_before y USING (cut, {ROUTE}, hour, day_of_week))"""


LATEST_CUT = "SELECT max(event_ts) AS cut FROM ev"
DAILY_CUTS = " UNION ALL ".join(f"SELECT TIMESTAMP '{c}' AS cut" for c in CUTOFFS)
LT_VALUES = [
    "baseline_speed_7d", "avg_speed_hour_dow_4w", "avg_delay_hour_dow_4w",
    "avg_delay_same_hour_yesterday", "avg_speed_same_hour_yesterday",
]
LT_OUT = f"SELECT {ROUTE}, hour, day_of_week, {r4(*LT_VALUES)}, source_cutoff, CAST(dt AS VARCHAR) AS dt FROM longterm"

# -- fixed state model ------------------------------------------------------------

MODEL_SQL_FEATURES = ["avg_speed", "avg_delay_minutes", "vehicle_count"]
FILL, MEAN, SCALE = (30.0, 3.0, 250.0), (45.0, 4.0, 250.0), (45.0, 6.0, 144.0)
CENTROIDS = ((1.2, -0.7, 0.0), (-0.3, -0.2, 0.1), (-0.9, 1.4, -0.1))
TRANSITIONS = {0: 1, 1: 1, 2: 1}
PROFILES = {
    0: ("clear", 90.0, 0.1),
    1: ("moderate", 32.5, 2.5),
    2: ("congested", 6.5, 14.75),
}


# A model over all features: parameters by rule, so that they differ between features.
WIDE_FILL = tuple(float(5 + 3 * i % 17) for i in range(len(MODEL_FEATURES)))
WIDE_MEAN = tuple(float(4 + 7 * i % 23) for i in range(len(MODEL_FEATURES)))
WIDE_SCALE = tuple(float(10 + 11 * i % 29) for i in range(len(MODEL_FEATURES)))
WIDE_CENTROIDS = tuple(
    tuple(((7 * i + 13 * k) % 9 - 4) / 4 for i in range(len(MODEL_FEATURES))) for k in range(3)
)


def _prediction(
    source: str = "ev", features=MODEL_SQL_FEATURES, fills=FILL, means=MEAN, scales=SCALE, centroids=CENTROIDS
) -> str:
    z = [
        f"(coalesce(CAST({f} AS DOUBLE), {fill}{_D}) - {mean}{_D}) / {scale}{_D}"
        for f, fill, mean, scale in zip(features, fills, means, scales, strict=True)
    ]
    distances = ", ".join(
        " + ".join(f"(({c}) - ({x}{_D})) * (({c}) - ({x}{_D}))" for c, x in zip(z, centre, strict=True)) + f" AS d{k}"
        for k, centre in enumerate(centroids)
    )
    nxt = " ".join(f"WHEN {a} THEN {b}" for a, b in TRANSITIONS.items())
    fields = ["status", "speed", "delay"]
    looked = ", ".join(
        "CASE predicted_cluster "
        + " ".join(f"WHEN {k} THEN {p[i]!r}" for k, p in PROFILES.items())
        + f" END AS exp_{name}"
        for i, name in enumerate(fields)
    )
    return f"""near AS (SELECT *, {distances} FROM {source}),
assigned AS (
  SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS current_cluster FROM near),
moved AS (SELECT *, CASE current_cluster {nxt} END AS predicted_cluster FROM assigned),
predicted AS (
  SELECT *, 30 AS forecast_horizon_minutes, exp_status AS traffic_status,
    CAST(exp_speed AS DOUBLE) AS expected_avg_speed, CAST(exp_delay AS DOUBLE) AS expected_avg_delay_minutes,
    'loaded' AS model_status, CAST(replace("timestamp", 'T', ' ') AS TIMESTAMP) AS prediction_time
  FROM (SELECT *, {looked} FROM moved))"""


PREDICTED = _prediction()
#: The whole chain: filled, enriched, long-term features looked up, all features scored.
LOOKED_UP = f"""looked AS (
  SELECT e.*, {', '.join('f.' + c for c in LT_VALUES)} FROM enriched e LEFT JOIN longterm f
    ON f.road_name = e.road_name AND f.district = e.district AND f.city = e.city
    AND f.hour = e.hour AND f.day_of_week = e.day_of_week)"""
WIDE_PREDICTED = _prediction("looked", MODEL_FEATURES, WIDE_FILL, WIDE_MEAN, WIDE_SCALE, WIDE_CENTROIDS)
PRED_FIELDS = """CAST(forecast_horizon_minutes AS INTEGER) AS forecast_horizon_minutes,
  CAST(current_cluster AS INTEGER) AS current_cluster, CAST(predicted_cluster AS INTEGER) AS predicted_cluster"""
NEWEST = f"""newest AS (
  SELECT prediction_time, {ROUTE}, {PRED_FIELDS}, traffic_status AS predicted_traffic_status,
    expected_avg_speed, expected_avg_delay_minutes, model_status FROM (
    SELECT *, row_number() OVER (PARTITION BY {ROUTE} ORDER BY prediction_time DESC,
      current_cluster, predicted_cluster, traffic_status, expected_avg_speed) AS rn FROM predicted) WHERE rn = 1)"""

LABEL = "CASE WHEN avg_speed >= 40 THEN 0 WHEN avg_speed >= 15 THEN 1 ELSE 2 END"

_FACETS = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {ROUTE} ORDER BY seq) AS position FROM ev)"""

_FILL = """sensor AS (SELECT * FROM ev WHERE event_type <> 'signup'),
both_sides AS (
  SELECT seq, 1 AS side, district, city, NULL AS w FROM sensor
  UNION ALL
  SELECT seq, 0, district, city, struct_pack(a := accident_count, t := temperature_celsius,
    h := humidity_percentage, c := weather_condition, r := is_rain) FROM ev WHERE event_type = 'signup'),
latest AS (
  SELECT seq, side, last_value(w IGNORE NULLS) OVER (
    PARTITION BY district, city ORDER BY seq, side ROWS UNBOUNDED PRECEDING) AS w FROM both_sides),
filled AS (
  SELECT s.* REPLACE (
    l.w.a AS accident_count,
    CASE WHEN s.seq % 5 = 0 THEN NULL ELSE l.w.t END AS temperature_celsius,
    l.w.h AS humidity_percentage, l.w.c AS weather_condition, l.w.r AS is_rain)
  FROM sensor s JOIN latest l ON l.seq = s.seq AND l.side = 1)"""
FILL_OUT = f"""SELECT seq, {ROUTE}, CAST(accident_count AS DOUBLE) AS accident_count, temperature_celsius,
  humidity_percentage, weather_condition, CAST(is_rain AS DOUBLE) AS is_rain FROM filled"""

_TRAIN_FEATURES = [
    "vehicle_count", "avg_speed", "min_speed", "max_speed", "avg_delay_minutes", "truck_ratio", "bus_ratio",
    "motorbike_ratio", "car_ratio", "taxi_ratio", "accident_count", "temperature_celsius",
    "humidity_percentage", "is_rain", "hour", "day_of_week", "is_weekend", "is_peak_hour", *LAG_OUT, *ROLL_OUT,
]
_TRAINING = f"""joined AS (
  SELECT e.*, {', '.join('f.' + c for c in LT_VALUES)}, f.source_cutoff AS feature_source_cutoff,
    row_number() OVER (PARTITION BY e.road_name, e.district, e.city, e.event_ts
      ORDER BY f.source_cutoff DESC NULLS LAST) AS feature_rank
  FROM enriched e LEFT JOIN longterm f ON f.road_name = e.road_name AND f.district = e.district
    AND f.city = e.city AND f.hour = e.hour AND f.day_of_week = e.day_of_week AND f.source_cutoff <= e.event_ts)"""
_TRAIN_OUT = ", ".join(
    f"{near(c)} AS {c}" if c in (*ROLL_OUT, *LT_VALUES) else c
    for c in [*_TRAIN_FEATURES, *LT_VALUES]
)

SCALED = ["avg_speed", "vehicle_count", "avg_delay_minutes", "latitude", "prev_avg_speed_3", "truck_ratio"]


def _scale() -> str:
    medians = ", ".join(f"median({c}) AS {c}" for c in SCALED)
    fill = ", ".join(f"coalesce(CAST(e.{c} AS DOUBLE), m.{c}) AS {c}" for c in SCALED)
    stats = ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN max({c}) = min({c}) THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in SCALED
    )
    out = ", ".join(f"{near(f'(({c} - m_{c}) / s_{c})')} AS z_{c}" for c in SCALED)
    return _with(
        EV,
        f"lagged AS (SELECT *, {_lags('seq')} FROM ev)",
        f"medians AS (SELECT {medians} FROM lagged)",
        f"filled_in AS (SELECT seq, {fill} FROM lagged e, medians m)",
        f"stats AS (SELECT {stats} FROM filled_in)",
        body=f"SELECT seq, {out} FROM filled_in, stats",
    )


PLANTED = """planted AS (
  SELECT r, k, (k // 2 + r) % 3 AS state, 90.0::DOUBLE - 40.0::DOUBLE * ((k // 2 + r) % 3) + (k % 5) / 10.0::DOUBLE AS s,
    8.0::DOUBLE * ((k // 2 + r) % 3) + (k % 3) / 10.0::DOUBLE AS d, CAST(100 + 200 * ((k // 2 + r) % 3) + k % 7 AS DOUBLE) AS v
  FROM (SELECT event_id % 6 AS r, event_id // 6 AS k FROM events))"""
_STATE_NAMES = "list_extract(['clear', 'moderate', 'congested'], CAST(state + 1 AS INTEGER))"
_METRICS = """z AS (SELECT state, (s - avg(s) OVER ()) / stddev_pop(s) OVER () AS s, (d - avg(d) OVER ()) / stddev_pop(d) OVER () AS d,
  (v - avg(v) OVER ()) / stddev_pop(v) OVER () AS v FROM planted),
p AS (SELECT state, round(s, 9) AS s, round(d, 9) AS d, round(v, 9) AS v, count(*) AS n FROM z GROUP BY ALL),
sizes AS (SELECT state, sum(n) AS size FROM p GROUP BY state),
means AS (SELECT a.state, a.s, a.d, a.v, a.n, b.state AS other,
  sum(b.n * sqrt((a.s - b.s) ** 2 + (a.d - b.d) ** 2 + (a.v - b.v) ** 2))
    / max(z.size - (a.state = b.state)::INT) AS mean
  FROM p a, p b JOIN sizes z ON z.state = b.state GROUP BY ALL),
ab AS (SELECT state, s, d, v, n, max(mean) FILTER (WHERE other = state) AS a, min(mean) FILTER (WHERE other <> state) AS b
  FROM means GROUP BY ALL),
centres AS (SELECT state, avg(s) AS s, avg(d) AS d, avg(v) AS v FROM z GROUP BY state)"""

ONLINE_KEY = (
    "'traffic:longterm:' || city || ':' || district || ':' || road_name || ':h' || "
    "lpad(CAST(hour AS VARCHAR), 2, '0') || ':dow' || day_of_week"
)
_LINEITEM_ORDER = (
    "l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
)

_topic_columns = ", ".join(
    ["avg_speed", "vehicle_count", "avg_delay_minutes", "accident_count", "weather_condition", *CALENDAR]
)


def oracle_sql() -> dict[str, str]:
    by_seq, by_arrival = "seq", "arrival, seq"
    slots = "hour, day_of_week"
    return {
        # serving
        "road_status_board": _with(EV, STATES, BOARD, body="SELECT * FROM board"),
        "traffic_summary": _with(
            EV,
            body=f"""SELECT count(*) AS total_events, count(DISTINCT road_name) AS total_roads,
  {near('avg(avg_speed)')} AS avg_speed, {near('avg(avg_delay_minutes)')} AS avg_delay,
  max(event_ts) AS latest_event_time FROM ev""",
        ),
        "status_counters": _with(
            EV, STATES,
            body="""SELECT count(*) FILTER (WHERE road_status = 'CONGESTED') AS congested_roads,
  count(*) FILTER (WHERE road_status = 'SLOW') AS slow_roads,
  count(*) FILTER (WHERE road_status = 'ACCIDENT') AS accident_roads,
  count(*) FILTER (WHERE road_status <> 'NORMAL') AS problem_roads FROM states""",
        ),
        "top_delayed_roads": _with(
            EV, STATES,
            body=f"SELECT {ROUTE}, avg_delay_minutes, avg_speed FROM states ORDER BY {_WORST} LIMIT 20",
        ),
        "board_filtered": _with(
            EV, STATES,
            body=f"""SELECT {ROUTE}, road_status, avg_speed FROM states
  WHERE district IN ('d1', 'd2', 'd7') AND road_status IN ('ACCIDENT', 'CONGESTED')""",
        ),
        "map_points": _with(
            EV, STATES,
            body="""SELECT latitude AS lat, longitude AS lon, road_name, district, road_status FROM states
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
        ),
        "filter_options": _with(
            EV, STATES, body="SELECT DISTINCT district FROM states WHERE district IS NOT NULL ORDER BY district"
        ),
        # projections
        "calendar_features": _with(
            EV, body=f"SELECT seq, {', '.join(f'CAST({c} AS INTEGER) AS {c}' for c in CALENDAR)} FROM ev"
        ),
        "event_time_lineage": _with(
            EV,
            body="""SELECT seq, "timestamp", TRY_CAST(replace("timestamp", 'T', ' ') AS TIMESTAMP) AS event_ts,
  CAST(CAST(TRY_CAST(replace("timestamp", 'T', ' ') AS TIMESTAMP) AS DATE) AS VARCHAR) AS dt,
  'trafic.enriched_events' AS source_topic, CAST(seq % 3 AS INTEGER) AS source_partition,
  seq // 3 AS source_offset FROM (SELECT seq, CASE WHEN seq % 11 = 0 THEN 'bad time' ELSE "timestamp" END
    AS "timestamp" FROM ev)""",
        ),
        "timeline_restamp": f"""WITH {EV}, k AS (
  SELECT seq, {ROUTE}, avg_speed, TIMESTAMP '2024-01-01 00:00:00'
    + to_minutes(15 * (row_number() OVER (PARTITION BY {ROUTE} ORDER BY seq) - 1)) AS event_ts FROM ev)
SELECT seq, {ROUTE}, avg_speed, event_ts, strftime(event_ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
  CAST(hour(event_ts) AS INTEGER) AS hour, CAST(isodow(event_ts) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(event_ts) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour(event_ts) BETWEEN 7 AND 9 OR hour(event_ts) BETWEEN 16 AND 19 AS INTEGER) AS is_peak_hour FROM k""",
        "first_seen_routes": _with(
            EV,
            body=f"""SELECT {ROUTE}, min(seq) AS first_seq, arg_min("timestamp", seq) AS "timestamp",
  arg_min(avg_speed, seq) AS avg_speed FROM ev GROUP BY {ROUTE}""",
        ),
        "facet_merge": _with(
            EV, _FACETS,
            body=f"""SELECT {ROUTE}, position, "timestamp", avg_speed, vehicle_count, hour, truck_count, car_ratio,
  accident_count, temperature_celsius, weather_condition FROM ranked""",
        ),
        "route_slugs": _with(
            EV,
            body=f"""SELECT DISTINCT {ROUTE}, {ROUTE.replace(', ', " || '|' || ")} AS route_key,
  replace('street_' || road_name, ' ', '_') AS online_slug, 'street-' || road_name AS path_slug FROM ev""",
        ),
        # enrichment
        "weather_latest_fill": _with(EV, _FILL, body=FILL_OUT),
        "lag_features": _with(
            EV, body=f"SELECT seq, {ROUTE}, {_lags(by_seq)} FROM ev"
        ),
        "rolling_count_window": _with(
            EV, enriched(by_arrival), body=f"SELECT seq, {ROUTE}, avg_speed, {r4(*ROLL_OUT)} FROM enriched"
        ),
        "enriched_events": _with(
            EV, _FILL, enriched(by_arrival, "filled"),
            body=f"""SELECT seq, {ROUTE}, "timestamp", avg_speed, vehicle_count,
  CAST(accident_count AS DOUBLE) AS accident_count, temperature_celsius,
  weather_condition, {', '.join(LAG_OUT)}, {r4(*ROLL_OUT)} FROM enriched""",
        ),
        "lineitem_lags": f"""SELECT l_partkey, l_orderkey, l_linenumber, l_quantity,
  lag(l_quantity, 1) OVER w AS prev_quantity_1, lag(l_quantity, 2) OVER w AS prev_quantity_2,
  lag(l_quantity, 3) OVER w AS prev_quantity_3 FROM lineitem
  WINDOW w AS (PARTITION BY l_partkey ORDER BY {_LINEITEM_ORDER})""",
        # rules
        "congestion_alerts": _with(EV, runs(by_seq), body=CONGESTION_OUT),
        "congestion_alerts_out_of_order": _with(EV, runs(by_arrival), body=CONGESTION_OUT),
        "accident_alerts": _with(EV, history(by_seq), body=ACCIDENT_OUT),
        "accident_alerts_out_of_order": _with(EV, history(by_arrival), body=ACCIDENT_OUT),
        # normalisation
        "alert_normalize": "WITH raws AS (SELECT event_id AS seq, "
        + RAW_ALERT.replace("{iso}", "strftime(ts, '%Y-%m-%dT%H:%M:%S')")
        + f" AS raw FROM events) {_normalize('congestion')} UNION ALL {_normalize('accident')}",
        "recent_alerts": _with(
            EV, runs(by_seq), history(by_seq), ALERTS,
            body=_RECENT,
        ),
        "alert_counters": _with(
            EV, runs(by_seq), history(by_seq), ALERTS,
            body="""SELECT count(*) AS recent_alerts,
  count(*) FILTER (WHERE alert_category = 'accident') AS accident_alerts,
  count(*) FILTER (WHERE alert_category = 'congestion') AS congestion_alerts FROM alerts""",
        ),
        "typed_events": _with(
            EV,
            body=f"""SELECT date_trunc('second', event_ts) AS event_time, "timestamp", {ROUTE}, {_topic_columns},
  latitude FROM ev""",
        ),
        "prediction_normalize": _with(
            EV, PREDICTED,
            body=f"""SELECT prediction_time, {ROUTE}, {PRED_FIELDS}, traffic_status AS predicted_traffic_status,
  expected_avg_speed, expected_avg_delay_minutes, model_status, 'trafic.predictions' AS source_topic
  FROM predicted""",
        ),
        "flatten_predictions": _with(
            EV, PREDICTED,
            body=f"""SELECT {ROUTE}, "timestamp", {PRED_FIELDS}, traffic_status, expected_avg_speed,
  expected_avg_delay_minutes, model_status FROM predicted""",
        ),
        # long-term features
        "source_cutoff": _with(EV, body="SELECT max(event_ts) AS source_cutoff FROM ev"),
        "baseline_7d": _with(
            EV, longterm(LATEST_CUT), body=f"SELECT {ROUTE}, {r4('baseline_speed_7d')} FROM lt_base"
        ),
        "hour_dow_28d": _with(
            EV, longterm(LATEST_CUT),
            body=f"""SELECT {ROUTE}, {slots}, {r4('avg_speed_hour_dow_4w', 'avg_delay_hour_dow_4w')} FROM lt_latest
  LEFT JOIN lt_hour USING ({ROUTE}, {slots})""",
        ),
        "latest_slot_dates": _with(
            EV, longterm(LATEST_CUT), body=f"SELECT {ROUTE}, {slots}, CAST(latest_date AS VARCHAR) AS latest_date FROM lt_latest"
        ),
        "prev_day_same_hour": _with(
            EV, longterm(LATEST_CUT),
            body=f"""SELECT {ROUTE}, {slots}, CAST(latest_date AS VARCHAR) AS latest_date,
  {r4('avg_delay_same_hour_yesterday', 'avg_speed_same_hour_yesterday')} FROM lt_before
  JOIN lt_latest USING (cut, {ROUTE}, {slots})""",
        ),
        "dense_slots": _with(
            EV,
            body=f"""SELECT {ROUTE}, CAST(h AS INTEGER) AS hour, CAST(w AS INTEGER) AS day_of_week
  FROM (SELECT DISTINCT {ROUTE} FROM ev), range(24) a(h), range(7) b(w)""",
        ),
        "longterm_features": _with(EV, longterm(LATEST_CUT), body=LT_OUT),
        "longterm_features_daily": _with(EV, longterm(DAILY_CUTS), body=LT_OUT),
        "online_snapshot": _with(
            EV, longterm(DAILY_CUTS),
            body=f"""SELECT feature_key, {r4(*LT_VALUES)}, source_cutoff FROM (
  SELECT {ONLINE_KEY} AS feature_key, {', '.join(
      f'arg_max({c}, source_cutoff) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in LT_VALUES)},
    max(source_cutoff) AS source_cutoff FROM longterm GROUP BY 1)""",
        ),
        "online_publish": _with(
            EV, longterm(DAILY_CUTS),
            body=f"""SELECT feature_key, CAST(2 + {' + '.join(f'({c} IS NOT NULL)::INT' for c in LT_VALUES)} AS BIGINT)
  AS n_fields, {r4(*LT_VALUES)}, TIMESTAMP '{CUTOFFS[-1]}' AS updated_at FROM (
  SELECT {ONLINE_KEY} AS feature_key, {', '.join(
      f'arg_max({c}, source_cutoff) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in LT_VALUES)}
  FROM longterm GROUP BY 1)""",
        ),
        "history_without_derived": _with(
            EV, enriched(by_seq), body=f"SELECT seq, {ROUTE}, avg_speed, vehicle_count FROM enriched"
        ),
        # training
        "training_readiness": _with(
            EV, longterm(DAILY_CUTS),
            """counts AS (SELECT (SELECT count(*) FROM ev) AS enriched_rows, (SELECT count(*) FROM longterm) AS feature_rows,
  (SELECT count(*) FROM ev e JOIN longterm f ON f.road_name = e.road_name AND f.district = e.district
    AND f.city = e.city AND f.hour = e.hour AND f.day_of_week = e.day_of_week
    AND f.source_cutoff <= e.event_ts) AS joinable_rows)""",
            body="SELECT *, least(enriched_rows, feature_rows, joinable_rows) >= 50 AS ready FROM counts",
        ),
        "asof_training_set": _with(
            EV, enriched(by_seq), longterm(DAILY_CUTS), _TRAINING,
            body=f"""SELECT 'run-1' AS training_run_id, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS dt, event_ts,
  {ROUTE}, {_TRAIN_OUT},
  feature_source_cutoff FROM joined WHERE feature_rank = 1""",
        ),
        "joinable_count": _with(
            EV, longterm(DAILY_CUTS),
            body="""SELECT count(*) AS joinable_rows FROM ev e JOIN longterm f ON f.road_name = e.road_name
  AND f.district = e.district AND f.city = e.city AND f.hour = e.hour AND f.day_of_week = e.day_of_week
  AND f.source_cutoff <= e.event_ts""",
        ),
        "row_audit": _with(
            EV,
            body="""SELECT count(*) AS rows, min(event_ts) AS min_event_ts, max(event_ts) AS max_event_ts,
  min(avg_speed) AS min_avg_speed, max(avg_speed) AS max_avg_speed FROM ev""",
        ),
        # clusters
        "impute_scale": _scale(),
        "nearest_cluster": _with(
            EV, PREDICTED, body=f"SELECT seq, {ROUTE}, CAST(current_cluster AS INTEGER) AS current_cluster FROM predicted"
        ),
        "cluster_profiles": _with(
            EV,
            f"labelled AS (SELECT *, {LABEL} AS cluster FROM ev)",
            """profiles AS (SELECT cluster, avg(avg_speed) AS avg_speed, avg(avg_delay_minutes) AS avg_delay_minutes,
  avg(vehicle_count) AS vehicle_count, count(*) AS samples FROM labelled GROUP BY cluster)""",
            body=f"""SELECT CAST(cluster AS INTEGER) AS cluster, {r4('avg_speed', 'avg_delay_minutes', 'vehicle_count')},
  samples, list_extract(['clear', 'moderate', 'congested'],
    least(3, row_number() OVER (ORDER BY avg_delay_minutes, cluster))) AS status FROM profiles""",
        ),
        "transition_map": _with(
            EV,
            f"daily AS (SELECT {ROUTE}, date_trunc('day', event_ts) AS t, {LABEL} AS cluster FROM ev)",
            """pairs AS (SELECT a.cluster, b.cluster AS nxt, count(*) AS n FROM daily a JOIN daily b
  ON a.road_name = b.road_name AND a.district = b.district AND a.city = b.city
  AND CAST(b.t AS TIMESTAMP) = CAST(a.t AS TIMESTAMP) + INTERVAL 1 DAY GROUP BY 1, 2)""",
            """best AS (SELECT cluster, nxt FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, nxt) AS rn FROM pairs) WHERE rn = 1)""",
            body="""SELECT CAST(k AS INTEGER) AS cluster, CAST(coalesce(nxt, k) AS INTEGER) AS next_cluster
  FROM range(4) r(k) LEFT JOIN best ON cluster = k""",
        ),
        "kmeans_planted": _with(
            PLANTED,
            """nxt AS (SELECT a.state, b.state AS following, count(*) AS n FROM planted a
  JOIN planted b ON b.r = a.r AND b.k = a.k + 2 GROUP BY ALL)""",
            """best AS (SELECT state, following FROM nxt QUALIFY row_number() OVER (PARTITION BY state ORDER BY n DESC) = 1)""",
            body=f"""SELECT {_STATE_NAMES} AS status, count(*) AS samples, {near('avg(s)')} AS avg_speed,
  {near('avg(d)')} AS avg_delay_minutes, {near('avg(v)')} AS vehicle_count,
  {_STATE_NAMES.replace('state', 'following')} AS next_status FROM planted JOIN best USING (state) GROUP BY state, following""",
        ),
        "kmeans_metrics": _with(
            PLANTED, _METRICS,
            body=f"""SELECT (SELECT round(sum((z.s - c.s) ** 2 + (z.d - c.d) ** 2 + (z.v - c.v) ** 2), 3) FROM z JOIN centres c USING (state)) AS inertia,
  (SELECT count(*) FROM planted a JOIN planted b ON b.r = a.r AND b.k = a.k + 2) AS transition_rows,
  {near('sum(n * (b - a) / greatest(a, b)) / sum(n)')} AS silhouette_score, 0.0::DOUBLE AS silhouette_error FROM ab""",
        ),
        "topic_view": _with(
            EV,
            body=f"""SELECT 'trafic.enriched_events' AS topic, CAST(seq % 3 AS INTEGER) AS "partition", seq // 3 AS "offset",
  "timestamp", {ROUTE}, avg_speed, vehicle_count, latitude, weather_condition, {', '.join(CALENDAR)},
  30 AS n_present FROM ev WHERE seq % 13 NOT IN (0, 1)""",
        ),
        # scoring
        "predict_next_state": _with(
            EV, PREDICTED,
            body=f"""SELECT seq, {ROUTE}, "timestamp", {PRED_FIELDS}, traffic_status, expected_avg_speed,
  expected_avg_delay_minutes, model_status FROM predicted""",
        ),
        "model_by_alias": _with(
            EV, PREDICTED,
            body=f"""SELECT seq, {ROUTE}, "timestamp", {PRED_FIELDS}, traffic_status, expected_avg_speed,
  expected_avg_delay_minutes, model_status FROM predicted""",
        ),
        "online_lookup": _with(
            EV, longterm(LATEST_CUT),
            body=f"""SELECT e.seq, {', '.join(f'{near("f." + c)} AS {c}' for c in LT_VALUES)} FROM ev e
  LEFT JOIN longterm f USING ({ROUTE}, {slots})""",
        ),
        "score_enriched": _with(
            EV, _FILL, enriched(by_seq, "filled"), longterm(LATEST_CUT), LOOKED_UP, WIDE_PREDICTED,
            body=f"""SELECT seq, {ROUTE}, "timestamp", {PRED_FIELDS}, traffic_status, expected_avg_speed,
  expected_avg_delay_minutes, model_status FROM predicted""",
        ),
        "latest_predictions": _with(
            EV, PREDICTED, NEWEST,
            body=f"SELECT * FROM newest ORDER BY prediction_time DESC, {ROUTE} LIMIT 500",
        ),
        "board_with_predictions": _with(
            EV, STATES, PREDICTED, NEWEST,
            body=f"""SELECT b.*, p.prediction_time, p.forecast_horizon_minutes, p.current_cluster, p.predicted_cluster,
  p.predicted_traffic_status, p.expected_avg_speed, p.expected_avg_delay_minutes, p.model_status FROM states b
  LEFT JOIN newest p USING ({ROUTE})""",
        ),
        "predicted_status_distribution": _with(
            EV, PREDICTED, NEWEST,
            body="""SELECT coalesce(nullif(predicted_traffic_status, ''), 'unknown') AS predicted_status,
  count(*) AS "count" FROM newest GROUP BY 1""",
        ),
        "prediction_counters": _with(
            EV, PREDICTED, NEWEST,
            body="""SELECT count(*) AS prediction_rows,
  count(*) FILTER (WHERE model_status = 'loaded') AS loaded_predictions,
  count(*) FILTER (WHERE model_status = 'unavailable') AS unavailable_predictions FROM newest""",
        ),
        # tables
        "offset_range_scan": _with(
            EV,
            body="""SELECT seq, "partition", "offset", avg_speed FROM (
  SELECT *, seq % 3 AS "partition", seq // 3 AS "offset" FROM ev)
  WHERE NOT ("partition" = 0 AND "offset" < 100) AND NOT ("partition" = 1 AND "offset" < 50)""",
        ),
        "merge_insert_only": _with(
            EV,
            body=f"""SELECT 'trafic.enriched_events' AS source_topic, CAST(seq % 3 AS INTEGER) AS source_partition,
  seq // 3 AS source_offset, CAST(dt AS VARCHAR) AS dt, {ROUTE}, avg_speed FROM ev""",
        ),
        "ingest_topic": _with(
            EV,
            body=f"""SELECT 'trafic.enriched_events' AS source_topic, CAST(seq % 3 AS INTEGER) AS source_partition,
  seq // 3 AS source_offset, CAST(dt AS VARCHAR) AS dt, {ROUTE}, avg_speed FROM ev""",
        ),
        "replace_by_key": _with(EV, longterm(DAILY_CUTS), body=LT_OUT),
        "lake_tables": _with(
            EV, enriched(by_seq), longterm(DAILY_CUTS), _TRAINING,
            body=f"""SELECT 'enriched_events' AS table_name, CAST(dt AS VARCHAR) AS dt, {ROUTE},
  seq // 3 AS number, {near('avg_speed')} AS value FROM ev
UNION ALL SELECT 'longterm_features', CAST(dt AS VARCHAR), {ROUTE}, hour * 7 + day_of_week,
  {near('baseline_speed_7d')} FROM longterm
UNION ALL SELECT 'training_kmeans_30m', CAST(CAST(event_ts AS DATE) AS VARCHAR), {ROUTE}, hour * 7 + day_of_week,
  {near('baseline_speed_7d')} FROM joined WHERE feature_rank = 1""",
        ),
        "ingest_ledger": _with(
            """m AS (SELECT event_id % 3 AS p, event_id // 3 AS o FROM events)""",
            """ends AS (SELECT p, min(o) AS first, max(o) + 1 AS e3,
  CASE WHEN p = 2 THEN max(o) + 1 ELSE max(o) FILTER (WHERE o < 200) + 1 END AS e2,
  max(o) FILTER (WHERE o < 100) + 1 AS e1, count(*) AS merged_rows FROM m GROUP BY p)""",
            """runs AS (SELECT 1 AS run, p, first AS s, e1 AS e, merged_rows FROM ends
  UNION ALL SELECT 2, p, e1, e2, merged_rows FROM ends UNION ALL SELECT 3, p, e2, e3, merged_rows FROM ends)""",
            body="""SELECT CAST(run AS INTEGER) AS run, CAST(p AS INTEGER) AS "partition", s AS start_offset,
  e AS end_offset, e - s AS n_records, merged_rows FROM runs""",
        ),
        "drain_predictions": _with(
            EV, PREDICTED,
            body=f"""SELECT {ROUTE}, "timestamp", {PRED_FIELDS}, traffic_status, expected_avg_speed,
  expected_avg_delay_minutes, model_status FROM predicted""",
        ),
        # streams
        "stream_enrich": _with(
            EV, _FILL, enriched(by_seq, "filled"),
            body=f"""SELECT seq, {ROUTE}, "timestamp", avg_speed, vehicle_count,
  CAST(accident_count AS DOUBLE) AS accident_count, temperature_celsius,
  weather_condition, {', '.join(LAG_OUT)}, {r4(*ROLL_OUT)} FROM enriched""",
        ),
        "stream_congestion": _with(EV, runs(by_seq), body=CONGESTION_OUT),
        "stream_accident": _with(EV, history(by_seq), body=ACCIDENT_OUT),
        "stream_alert_table": _with(
            EV, runs(by_seq), history(by_seq), ALERTS, body="SELECT * FROM alerts"
        ),
        "stream_score": _with(
            EV, PREDICTED,
            body=f"""SELECT prediction_time, {ROUTE}, {PRED_FIELDS}, traffic_status AS predicted_traffic_status,
  expected_avg_speed, expected_avg_delay_minutes, model_status FROM predicted""",
        ),
        "pipeline_once": _with(
            EV, _FILL, chained(by_seq), runs("emit_seq", source="chain"), history("emit_seq", "chain"), ALERTS,
            longterm(LATEST_CUT), LOOKED_UP, WIDE_PREDICTED,
            body=f"""SELECT 'enriched_events' AS table_name, {ROUTE}, event_ts AS at, weather_condition AS label,
  {near('rolling_avg_speed_3')} AS value FROM enriched
UNION ALL SELECT 'traffic_alerts', {ROUTE}, alert_time, alert_category || ' ' || severity, {near('avg_speed')} FROM alerts
UNION ALL SELECT 'traffic_predictions', {ROUTE}, prediction_time,
  CAST(current_cluster AS VARCHAR) || ' ' || traffic_status, {near('expected_avg_delay_minutes')} FROM predicted""",
        ),
    }
