"""Golden scenarios with derived values."""

from datetime import datetime

import pytest
from conftest import RECORD, frame, record, rows_of
from pyspark.sql import functions as F

from roadstate.functions import scalars
from roadstate.functions.slugs import dash_slug, safe_name, slug
from roadstate.operators import asof, clusters, enrich, features, normalize, projections, rules
from roadstate.plans import serving


def test_congestion_scenario(spark):
    volumes = [420, 450, 480, 510, 540]
    rows = [record(i, minute=15 * i, speed=7.0, volume=v) for i, v in enumerate(volumes)]
    enriched = enrich.enrich_series(frame(spark, rows), emit_order="emitted").orderBy("emitted").collect()
    assert [r["seq"] for r in enriched] == [2, 3, 4]
    lags = [[r[f"prev_vehicle_count_{k}"] for k in (1, 2, 3)] for r in enriched]
    assert lags == [[450, 420, None], [480, 450, 420], [510, 480, 450]]
    assert [r["rolling_vehicle_count_3"] for r in enriched] == [450, 480, 510]
    source = enrich.enrich_series(frame(spark, rows))
    alerts = rules.congestion_alerts(source).collect()
    assert len(alerts) == 1
    a = alerts[0]
    assert (a["seq"], a["low_speed_event_count"], a["low_speed_duration_minutes"]) == (4, 3, 30)
    assert a["severity"] == "medium" and tuple(a["matched_by"]) == (True, True)
    assert a["rule"] == "3_events_or_30m_avg_speed_lt_10.0"
    assert rules.accident_alerts(source).isEmpty()


def test_accident_scenario(spark):
    rows = [
        record(0, minute=0, speed=28, volume=260),
        record(1, minute=15, speed=24, volume=300),
        record(2, minute=30, speed=9, volume=480, accidents=2),
    ]
    source = enrich.enrich_series(frame(spark, rows))
    row = source.collect()
    assert len(row) == 1 and row[0]["rolling_avg_speed_3"] == pytest.approx(61 / 3)
    assert [row[0][f"prev_avg_speed_{k}"] for k in (1, 2, 3)] == [24, 28, None]
    alerts = rules.accident_alerts(source).collect()
    assert len(alerts) == 1 and alerts[0]["severity"] == "high"
    assert (alerts[0]["history_avg_accident_count"], alerts[0]["history_max_accident_count"]) == (0, 0)
    assert tuple(alerts[0]["matched_by"]) == (True, True, True)
    assert rules.congestion_alerts(source).isEmpty()


def test_calendar(spark):
    texts = ["2024-01-01T07:00:00", "2024-01-01T10:00:00", "2024-01-06T19:59:00", "2024-01-06T20:00:00"]
    df = projections.with_event_time(spark.createDataFrame([(t,) for t in texts], "timestamp string"))
    got = projections.with_calendar(df).select("hour", "day_of_week", "is_weekend", "is_peak_hour").collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 1), (10, 0, 0, 0), (19, 5, 1, 1), (20, 5, 1, 0)]


def test_bad_time_is_null(spark):
    df = spark.createDataFrame([("junk",), (None,), ("2024-01-01T00:00:00Z",)], "timestamp string")
    got = [r["event_ts"] for r in projections.with_event_time(df).collect()]
    assert got == [None, None, datetime(2024, 1, 1)]


def test_weather_presence(spark):
    areas = "seq long, district string, city string"
    events = frame(
        spark,
        [
            {"seq": 0, "district": "d", "city": "c"},
            {"seq": 2, "district": "d", "city": "c", "present": ["temperature_celsius"]},
            {"seq": 3, "district": "d", "city": "c"},
            {"seq": 5, "district": "d", "city": "c"},
            {"seq": 6, "district": "other", "city": "c"},
        ],
        areas + ", temperature_celsius double, present array<string>",
    )
    weather = frame(
        spark,
        [
            {"seq": 1, "district": "d", "city": "c", "temperature_celsius": 20.0},
            {"seq": 4, "district": "d", "city": "c", "temperature_celsius": 30.0},
        ],
        areas + ", temperature_celsius double",
    )
    filled = enrich.latest_fill(events, weather, fields=["temperature_celsius"], present="present")
    got = {r["seq"]: r["temperature_celsius"] for r in filled.collect()}
    assert got == {0: None, 2: None, 3: 20.0, 5: 30.0, 6: None}


def test_out_of_order_window(spark):
    rows = [record(i, minute=m, speed=s) for i, (m, s) in enumerate([(0, 10), (30, 20), (15, 30), (45, 40)])]
    out = enrich.enrich_series(frame(spark, rows), emit_order="emitted").orderBy("emitted").collect()
    assert [(r["timestamp"][11:16], r["rolling_avg_speed_3"], r["prev_avg_speed_1"]) for r in out] == [
        ("00:30", 20.0, 10.0), ("00:45", 30.0, 30.0),
    ]


def test_congestion_reset(spark):
    speeds = [9, 9, 10, 9, 9]
    df = frame(spark, [record(i, minute=5 * i, speed=s) for i, s in enumerate(speeds)])
    assert rules.congestion_alerts(df).isEmpty()
    late = rules.congestion_alerts(frame(spark, [record(0, minute=0, speed=9), record(1, minute=31, speed=9)])).collect()
    assert len(late) == 1
    assert (late[0]["low_speed_event_count"], late[0]["low_speed_duration_minutes"]) == (2, 31)
    assert tuple(late[0]["matched_by"]) == (False, True)


@pytest.mark.parametrize(
    "counts, fired", [([1, 1, 1, 1], [0]), ([1, 0, 0, 0, 0, 0, 0, 1], [0, 7])]
)
def test_accident_history(spark, counts, fired):
    df = frame(spark, [record(i, minute=i, accidents=c) for i, c in enumerate(counts)])
    assert [r["seq"] for r in rules.accident_alerts(df).orderBy("seq").collect()] == fired


def test_point_in_time(spark):
    base = record(0, minute=0)
    events = frame(
        spark,
        [dict(base, seq=i, event_ts=datetime(2024, 1, 1, h, m)) for i, (h, m) in enumerate([(9, 59), (10, 0), (10, 59), (11, 0)])],
    )
    cuts = [dict(base, source_cutoff=datetime(2024, 1, 1, h), v=v) for h, v in ((10, 1.0), (11, 2.0))]
    right = frame(
        spark, cuts,
        "road_name string, district string, city string, hour int, day_of_week int, source_cutoff timestamp_ntz, v double",
    )
    got = asof.asof_left(events, right, payload=["v"]).orderBy("seq").collect()
    assert [r["v"] for r in got] == [None, 1.0, 1.0, 2.0]
    assert asof.joinable_count(events, right).first()[0] == 4


def test_longterm_grid(spark):
    one = [record(0, minute=90, speed=10.0)]
    df = frame(spark, one + one)
    grid = features.longterm_features(df)
    assert grid.count() == 168
    assert grid.where("baseline_speed_7d = 10.0").count() == 168
    assert grid.where("avg_speed_hour_dow_4w IS NOT NULL").count() == 1
    assert grid.where("avg_speed_same_hour_yesterday IS NOT NULL").isEmpty()
    assert features.longterm_features(df.where("false")).isEmpty()


def test_transitions(spark):
    def states(pairs):
        rows = []
        for i, (a, b) in enumerate(pairs):
            for m, c in ((0, a), (30, b)):
                rows.append((f"R{i}", "d", "c", datetime(2024, 1, 1, 0, m), c))
        return spark.createDataFrame(
            rows, "road_name string, district string, city string, event_ts timestamp_ntz, cluster int"
        )

    def mapped(pairs):
        counts = clusters.transition_counts(states(pairs))
        return {r[0]: r[1] for r in clusters.transition_map(counts, 4).collect()}

    assert mapped([(0, 1), (0, 1), (0, 2), (1, 1)]) == {0: 1, 1: 1, 2: 2, 3: 3}
    assert mapped([(0, 1), (0, 2)])[0] == 1
    # Copies multiply, as a join would have them.
    twice = states([(0, 1)]).union(states([(0, 1)]))
    assert clusters.transition_counts(twice).first()["pairs"] == 4


def test_status_rules(spark):
    rows = [(1, 50.0, 0.0), (0, 9.9, 0.0), (0, 50.0, 10.0), (0, 19.9, 0.0), (0, 50.0, 5.0), (0, 20.0, 4.9), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, s double, d double")
    got = [r[0] for r in df.select(scalars.road_status("a", "s", "d")).collect()]
    assert got == ["ACCIDENT", "CONGESTED", "CONGESTED", "SLOW", "SLOW", "NORMAL", "NORMAL"]


def test_latest_non_null(spark):
    schema = RECORD + ", latitude double"
    df = frame(spark, [record(0, minute=0, speed=5, latitude=21.0), record(1, minute=1, speed=9)], schema)
    row = enrich.latest_non_null(df, ["latitude", "avg_speed"]).first()
    assert (row["latitude"], row["avg_speed"], row["last_event_time"].minute) == (21.0, 9.0, 1)


def test_slugs(spark):
    names = ["Đường Nguyễn Trãi", "", None, "  ", "ﬁre ½ Ⅷ", "Ñandú—Straße", "İzmir"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [tuple(r) for r in df.select(slug("n"), dash_slug("n")).collect()]
    assert got == [
        ("duong_nguyen_trai", "duong-nguyen-trai"),
        ("unknown", ""),
        ("unknown", ""),
        ("unknown", ""),
        ("fire_12_viii", "re"),
        ("nandustrae", "nandu-stra-e"),
        ("izmir", "izmir"),
    ]
    runs = spark.createDataFrame([("manual__2024-01-01T00:00:00+00:00",), ("---",), ("a b",)], "n string")
    assert [r[0] for r in runs.select(safe_name("n")).collect()] == ["manual__2024-01-01T00-00-00-00-00", "run", "a-b"]


def test_slug_equals_unicode_rules(spark):
    """Every character that folds, against the rule itself."""
    import re
    import unicodedata

    chars = [chr(c) for c in [*range(1, 0x3000), *range(0xF900, 0xFB50), *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D480)]]
    chars = [c for c in chars if not 0xD800 <= ord(c) < 0xE000]

    def rule(value):
        text = (value or "unknown").replace("Đ", "D").replace("đ", "d")
        text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")
        return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_") or "unknown"

    df = spark.createDataFrame([(f"a{c}b",) for c in chars], "n string")
    wrong = [r["n"] for r in df.select("n", slug("n").alias("s")).collect() if r["s"] != rule(r["n"])]
    assert wrong == []


def test_alert_defaults(spark):
    raw = spark.createDataFrame(
        [('{"road":"X","level":"high","event_time":"2024-01-01T00:00:00"}',), ('{"timestamp":"2024-01-01T00:00:01.9"}',)],
        "value string",
    )
    first, second = normalize.normalize_alerts(raw, "accident").collect()
    assert (first["road_name"], first["severity"], first["alert_time"]) == ("X", "high", datetime(2024, 1, 1))
    assert first["message"] == "Congestion alert"
    assert (first["district"], first["city"]) == ("", "")
    assert (first["avg_speed"], first["avg_delay_minutes"], first["accident_count"]) == (None, None, None)
    assert (second["severity"], second["alert_time"]) == ("warning", datetime(2024, 1, 1, 0, 0, 1))


def test_json_types_are_strict(spark):
    doc = '{"i": 2, "f": 2.0, "q": "2", "e": 1e3, "b": true, "n": null, "big": 9223372036854775808}'
    names = ["i", "f", "q", "e", "b", "n", "big", "absent"]
    df = spark.createDataFrame([(doc,)], "value string").select(scalars.json_doc("value", *names).alias("d"))
    fields = [F.col("d")[n] for n in names]
    doubles = df.select(*[scalars.json_double(f) for f in fields]).first()
    longs = df.select(*[scalars.json_long(f) for f in fields]).first()
    texts = df.select(*[scalars.json_text(f) for f in fields]).first()
    assert list(doubles)[:6] == [2.0, 2.0, None, 1000.0, None, None]
    assert list(longs) == [2, None, None, None, None, None, None, None]
    assert list(texts) == [None, None, "2", None, None, None, None, None]


def test_malformed_alert_keeps_its_text(spark):
    raw = spark.createDataFrame([("oops",), (None,)], "value string")
    rows = normalize.normalize_alerts(raw, "congestion").drop("alert_time").collect()
    assert [r["raw_message"] for r in rows] == ["oops", None]
    assert all(r["severity"] == "warning" and r["road_name"] == "" for r in rows)


def test_normalize_predictions(spark):
    raw = spark.createDataFrame(
        [
            ('{"road_name":"r","timestamp":"2024-01-01T00:00:00","prediction_30m":{"forecast_horizon_minutes":30,'
             '"current_cluster":1,"predicted_cluster":null,"traffic_status":null,"expected_avg_speed":2.5,"model_status":"loaded"}}',),
            ('{"timestamp":"2024-01-01T00:00:00"}',),
        ],
        "value string",
    )
    a, b = normalize.normalize_predictions(raw).collect()
    assert (a["forecast_horizon_minutes"], a["current_cluster"], a["predicted_cluster"]) == (30, 1, None)
    assert (a["predicted_traffic_status"], a["expected_avg_speed"], a["model_status"]) == ("", 2.5, "loaded")
    assert (b["forecast_horizon_minutes"], b["road_name"], b["current_cluster"]) == (0, "", None)


def test_board_order_and_map(spark):
    schema = RECORD + ", latitude double, longitude double, weather_condition string, is_rain int"
    rows = [
        record(0, "A", 0, 20.0, delay=5.0), record(1, "B", 0, 5.0, delay=16.0, latitude=1.0, longitude=2.0),
        record(2, "C", 0, None), record(3, "D", 0, 4.0, delay=16.0),
    ]
    board = serving.road_status_board(frame(spark, rows, schema))
    assert [r["road_name"] for r in board.collect()] == ["D", "B", "A", "C"]
    assert rows_of(projections.map_points(board)) == [(1.0, 2.0, "B", "Demo", "CONGESTED")]
    assert [r[0] for r in serving.top_delayed(board, 2).select("road_name").collect()] == ["D", "B"]
