"""Order-sensitive operators against sequential models, whole and split."""

import random

import models
import pytest
from conftest import RECORD, frame, record, rows_of
from pyspark.sql import functions as F

from roadstate.operators import asof, enrich, rules
from roadstate.operators.series import SEGMENT, SeriesLayout, running_last, running_sum, series_rank
from roadstate.schemas import AREA_KEYS, ROUTE_KEYS


def shuffled(seed, rows=240):
    """Records of uneven routes (one holds over a third) arriving out of order."""
    rng = random.Random(seed)
    arrivals = list(range(rows))
    rng.shuffle(arrivals)
    data = []
    for i in range(rows):
        road = "hot" if rng.random() < 0.4 else f"R{rng.randrange(9)}"
        data.append(
            record(
                i, road, minute=rng.randrange(0, 3000, 5),
                speed=rng.choice([None, 0.0, 3.0, 6.9, 7.0, 9.99, 10.0, 35.5]) if rng.random() < 0.9 else 80.0,
                volume=rng.randrange(500), accidents=rng.choice([0, 0, 0, 0, 1, 1, 2, 4, None]), arrival=arrivals[i],
            )
        )
    return data


SCHEMA = RECORD + ", arrival long"
ORDER = ("arrival",)


@pytest.fixture(scope="module", params=[0, 1])
def data(request, spark):
    rows = shuffled(request.param)
    return rows, frame(spark, rows, SCHEMA).cache()


def layouts(df, keys=ROUTE_KEYS, order=ORDER):
    """A whole layout and two split ones, with long and with tiny segments."""
    whole = SeriesLayout.measure(df, keys, order)
    assert not whole.split
    splits = [SeriesLayout.measure(df, keys, order, max_rows=n) for n in (25, 3)]
    assert all(s.split for s in splits)
    return [whole, *splits]


def test_segments_are_ranges_and_bounded(data):
    _, df = data
    layout = SeriesLayout.measure(df, ROUTE_KEYS, ORDER, max_rows=20)
    placed = layout.assign(df)
    assert placed.count() == df.count()
    hot = placed.where(F.col("road_name") == "hot")
    bounds = (
        hot.groupBy(SEGMENT).agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi"), F.count("*").alias("n"))
        .orderBy(SEGMENT).collect()
    )
    assert len(bounds) > 2
    assert all(a["hi"] < b["lo"] for a, b in zip(bounds, bounds[1:], strict=False))
    assert max(b["n"] for b in bounds) <= 60
    small = placed.where(~F.col("road_name").isin([r["road_name"] for r in layout.hot.collect()]))
    assert small.where(F.col(SEGMENT).isNotNull()).isEmpty()


def test_rank(data):
    _, df = data
    results = [rows_of(series_rank(df, ROUTE_KEYS, ORDER, layout=x), "seq", "position") for x in layouts(df)]
    assert results[0] == results[1] == results[2]


def test_running_values(data):
    rows, df = data
    marked = df.withColumn("v", F.when(F.col("accident_count") > 0, F.col("seq")))
    lasts = [rows_of(running_last(marked, "v", ROUTE_KEYS, ORDER, x), "seq", "v") for x in layouts(df)]
    assert lasts[0] == lasts[1] == lasts[2]
    ones = df.withColumn("v", F.col("vehicle_count"))
    sums = [rows_of(running_sum(ones, "v", ROUTE_KEYS, ORDER, x), "seq", "v") for x in layouts(df)]
    assert sums[0] == sums[1] == sums[2]
    expected = []
    for series in models.by_route(rows, "arrival"):
        total = 0
        for r in series:
            total += r["vehicle_count"]
            expected.append((r["seq"], total))
    assert sums[0] == sorted(expected, key=repr)


def test_lags_and_window(data):
    rows, df = data
    expected = models.lags_and_window(rows, "arrival")
    for layout in layouts(df):
        out = enrich.enrich_series(df, order=ORDER, emit_order="emitted", layout=layout)
        got = sorted(
            tuple(r)
            for r in out.select(
                "emitted", "seq", "prev_avg_speed_1", "prev_avg_speed_2", "prev_avg_speed_3",
                F.round("rolling_avg_speed_3", 6),
            ).collect()
        )
        assert got == expected
        apart = enrich.count_window(
            enrich.with_lags(df, order=ORDER, layout=layout), order=ORDER, emit_order="emitted", layout=layout
        )
        assert rows_of(apart) == rows_of(out.select(*apart.columns))


def test_congestion(data):
    rows, df = data
    for speed in (10.0, 40.0):
        expected = models.congestion(rows, speed, order="arrival")
        assert expected
        for layout in layouts(df):
            alerts = rules.congestion_alerts(
                df.withColumn("id", F.col("seq")), speed, order=("arrival", "seq"), layout=layout
            )
            got = sorted(
                tuple(r)
                for r in alerts.select(
                    "seq", "low_speed_event_count", "low_speed_duration_minutes",
                    "matched_by.consecutive_events", "matched_by.duration", "severity",
                ).collect()
            )
            assert got == expected


def test_congestion_run_longer_than_segments(spark):
    """One run over all segments, and one that a reset at a border ends."""
    rows = [record(i, "hot", i, 5.0) for i in range(200)]
    rows[120]["avg_speed"] = 30.0
    df = frame(spark, rows)
    expected = models.congestion(rows)
    for n in (5, 40, 121):
        layout = SeriesLayout.measure(df, ROUTE_KEYS, ("seq",), max_rows=n)
        assert layout.split
        got = rules.congestion_alerts(df, layout=layout).select(
            "seq", "low_speed_event_count", "low_speed_duration_minutes",
            "matched_by.consecutive_events", "matched_by.duration", "severity",
        )
        assert sorted(tuple(r) for r in got.collect()) == expected


def test_accidents(data):
    rows, df = data
    expected = models.accidents(rows, order="arrival")
    for layout in layouts(df):
        got = rules.accident_alerts(df, order=("arrival", "seq"), layout=layout).select(
            "seq", "accident_count", "history_avg_accident_count", "history_max_accident_count",
            "matched_by.first_accident_after_clean_history", "matched_by.spike_vs_history", "matched_by.multi_accident",
        )
        assert sorted(tuple(r) for r in got.collect()) == expected


def test_accident_history_must_be_bounded(data):
    with pytest.raises(ValueError):
        rules.accident_alerts(data[1], history=0)


def test_weather_fill(spark):
    rng = random.Random(7)
    events, updates = [], []
    for i in range(200):
        area = {"district": rng.choice(["A", "B"]), "city": "X"}
        if rng.random() < 0.2 and area["district"] != "B":
            updates.append({"seq": i, **area, "temperature_celsius": rng.choice([None, 10.0, 20.0])})
        else:
            present = ["temperature_celsius"] if rng.random() < 0.3 else None
            value = rng.choice([None, 1.0]) if present else None
            events.append({"seq": i, **area, "temperature_celsius": value, "present": present})
    left = frame(spark, events, "seq long, district string, city string, temperature_celsius double, present array<string>")
    right = frame(spark, updates, "seq long, district string, city string, temperature_celsius double")
    expected = models.weather_fill(events, updates)
    both = left.select("seq", *AREA_KEYS).union(right.select("seq", *AREA_KEYS))
    for n in (10_000, 15, 4):
        layout = SeriesLayout.measure(both, AREA_KEYS, ("seq",), max_rows=n)
        assert layout.split == (n < 100)
        filled = enrich.latest_fill(
            left, right, fields=["temperature_celsius"], present="present", layout=layout
        )
        got = sorted((tuple(r) for r in filled.select("seq", "temperature_celsius").collect()), key=lambda r: r[0])
        assert got == expected


def test_asof_and_joinable(data, spark):
    rows, df = data
    rng = random.Random(3)
    from datetime import datetime, timedelta

    features, seen = [], set()
    for _ in range(400):
        e = rng.choice(rows)
        cut = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(0, 3000, 5))
        key = (e["road_name"], e["hour"], e["day_of_week"], cut)
        if key not in seen:
            seen.add(key)
            features.append({**{k: e[k] for k in asof.ASOF_KEYS}, "source_cutoff": cut, "v": float(len(features))})
    right = frame(
        spark, features,
        "road_name string, district string, city string, hour int, day_of_week int, source_cutoff timestamp_ntz, v double",
    )
    expected = models.asof(rows, features)
    both = df.select(*asof.ASOF_KEYS, F.col("event_ts").alias("_time")).union(
        right.select(*asof.ASOF_KEYS, F.col("source_cutoff").alias("_time"))
    )
    for n in (10_000, 4):
        layout = SeriesLayout.measure(both, asof.ASOF_KEYS, ("_time",), max_rows=n)
        assert layout.split == (n < 100)
        got = asof.asof_left(df, right, payload=["v"], layout=layout)
        assert got.count() == len(rows)
        pairs = sorted((tuple(r) for r in got.select("seq", "feature_source_cutoff").collect()), key=lambda r: r[0])
        assert pairs == [e[:2] for e in expected]
        assert got.where(F.col("feature_source_cutoff") > F.col("event_ts")).isEmpty()
        total = asof.joinable_count(df, right, layout=layout).first()[0]
        assert total == sum(e[2] for e in expected)


def test_merge_facets_and_first_seen(spark):
    rows = [record(i, f"R{i % 2}", i, 10.0 + i) for i in range(10)]
    df = frame(spark, rows)
    a = df.select("seq", *ROUTE_KEYS, "avg_speed", F.lit("a").alias("who"))
    b = df.select(
        "seq", *ROUTE_KEYS, "vehicle_count", F.when(F.col("seq") > 3, F.lit("b")).alias("who")
    ).where("seq < 8")
    merged = enrich.merge_facets(a, b)
    got = rows_of(merged, "road_name", "position", "avg_speed", "who")
    # The shorter facet bounds the result; a missing later value keeps the earlier.
    assert got == sorted(
        [(f"R{i % 2}", i // 2 + 1, 10.0 + i, "b" if i > 3 else "a") for i in range(8)], key=repr
    )
    first = enrich.first_seen(df, columns=["avg_speed"])
    assert rows_of(first, "road_name", "first_seq", "avg_speed") == [("R0", 0, 10.0), ("R1", 1, 11.0)]


def test_records_without_a_key_are_split_too(spark):
    rows = [r | {"road_name": None if r["road_name"] == "hot" else r["road_name"]} for r in shuffled(3)]
    df = frame(spark, rows, SCHEMA).cache()
    forms = layouts(df)
    hot = forms[1].assign(df).where("road_name IS NULL")
    assert hot.select(SEGMENT).distinct().count() > 1 and hot.where(F.col(SEGMENT).isNull()).isEmpty()
    for run in (
        lambda x: rows_of(series_rank(df, ROUTE_KEYS, ORDER, layout=x), "seq", "position"),
        lambda x: rows_of(running_last(df, "accident_count", ROUTE_KEYS, ORDER, x), "seq", "accident_count"),
        lambda x: rows_of(running_sum(df, "vehicle_count", ROUTE_KEYS, ORDER, x), "seq", "vehicle_count"),
        lambda x: rows_of(enrich.with_lags(df, order=ORDER, layout=x), "seq", "prev_avg_speed_1", "prev_delay_3"),
        lambda x: rows_of(rules.accident_alerts(df, order=("arrival", "seq"), layout=x), "seq", "accident_count"),
        lambda x: rows_of(rules.congestion_alerts(df, 40.0, order=("arrival", "seq"), layout=x), "seq"),
    ):
        whole, *split = [run(x) for x in forms]
        assert whole and all(s == whole for s in split)


def tied(spark, rows=400):
    """One key with a third of the rows, all with one value in the first order column."""
    rng = random.Random(9)
    data = [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", 5 if i % 3 == 0 else rng.randrange(9),
         rng.choice([None, "a", "b", "ü"]), rng.choice([None, 1.5, float("nan"), -2.0]), i, rng.choice([None, i]))
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "key string, a int, b string, c double, id long, v long").repartition(3)


def test_tied_first_order_column_is_cut(spark):
    df, order = tied(spark).cache(), ("a", "b", "c", "id")
    whole = SeriesLayout.measure(df, ["key"], order)
    for n in (40, 7):
        split = SeriesLayout.measure(df, ["key"], order, max_rows=n)
        sizes = split.assign(df).where("key = 'hot'").groupBy(SEGMENT).count().collect()
        assert len(sizes) > 2 and max(r["count"] for r in sizes) <= 3 * n
        for run in (
            lambda x: rows_of(series_rank(df, ["key"], order, layout=x), "id", "position"),
            lambda x: rows_of(running_last(df, "v", ["key"], order, x), "id", "v"),
            lambda x: rows_of(running_sum(df, "id", ["key"], order, x), "key", "a", "b", "id"),
            lambda x: rows_of(enrich.with_lags(df, {"id": "p"}, 3, ["key"], order, x), "id", "p_1", "p_2", "p_3"),
        ):
            assert run(split) == run(whole)


def test_cut_points_are_a_constant_of_the_plan(spark):
    df = tied(spark)
    split = SeriesLayout.measure(df, ["key"], ("a", "b", "c", "id"), max_rows=7)
    plan = split.assign(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "sort_array" not in plan


def test_times_keep_their_digits_as_cut_points(spark):
    micro = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1000000)"
    df = spark.range(500).selectExpr("1 AS key", f"{micro} AS t", f"CAST({micro} AS timestamp) AS u", "id")
    for order in (("t",), ("u",)):
        split = SeriesLayout.measure(df, ["key"], order, max_rows=50)
        sizes = [r["count"] for r in split.assign(df).groupBy(SEGMENT).count().collect()]
        assert len(sizes) >= 8 and max(sizes) < 130
        assert rows_of(series_rank(df, ["key"], order, layout=split), "id", "position") == [(i, i + 1) for i in sorted(range(500), key=lambda i: repr((i, i + 1)))]


def test_asof_with_one_time_for_all_events(spark):
    rows = [record(i, "hot", 60, float(i)) for i in range(200)] + [record(900 + i, f"R{i}", 60) for i in range(100)]
    df = frame(spark, rows)
    cut = "timestamp_ntz'2024-01-01 00:30:00'"
    right = df.select(*asof.ASOF_KEYS).distinct().withColumns({"source_cutoff": F.expr(cut), "v": F.lit(1.0)})
    bare = df.select(*asof.ASOF_KEYS, F.col("event_ts").alias("_time"), F.lit(1).alias("_side"), asof.tie_breaker(df).alias("_tie"))
    layout = SeriesLayout.measure(bare, asof.ASOF_KEYS, asof.ASOF_ORDER, max_rows=20)
    assert layout.assign(bare).where("road_name = 'hot'").select(SEGMENT).distinct().count() > 4
    got = asof.asof_left(df, right, payload=["v"], layout=layout)
    assert got.count() == 300 and got.where("v IS NULL").isEmpty()
    assert rows_of(got) == rows_of(asof.asof_left(df, right, payload=["v"]))


def test_joinable_count_makes_no_table_of_the_feature_rows(spark):
    events = frame(spark, [record(i, f"R{i % 2}", 5 * i) for i in range(8)])
    right = events.select(*asof.ASOF_KEYS).withColumn("source_cutoff", F.lit("2024-01-01").cast("timestamp_ntz"))
    # Eight events, each with the four copies of the features of its route.
    assert asof.joinable_count(events, right).first()[0] == 32
    plan = asof.joinable_count(events, right)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # events of one time, and the total
