"""Physical plans: shuffles, scans, joins."""

import contextlib
import io
import re

import pytest
from conftest import SF, frame, record
from pyspark.sql import functions as F

from roadstate.operators import enrich, features, rules
from roadstate.operators.series import SeriesLayout
from roadstate.plans import registry, serving
from roadstate.schemas import ROUTE_KEYS
from roadstate.sources import topics


@pytest.fixture(autouse=True)
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_one_shuffle_per_series_operator(spark):
    events = registry.ev(spark, SF)
    for df in (
        enrich.with_lags(events),
        enrich.enrich_series(events),
        rules.congestion_alerts(events),
        rules.accident_alerts(events),
    ):
        text = plan(df)
        assert len(re.findall(r"Exchange ", text)) == 1
        assert len(re.findall(r"\bSort \[", text)) == 1
        assert "Join" not in text


def test_latest_fill_has_no_join(spark):
    text = plan(registry.weather_latest_fill(spark, SF))
    assert "Join" not in text and len(re.findall("Exchange ", text)) == 1


def test_scan_reads_only_what_is_used(spark):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan(registry.calendar_features(spark, SF))
    board = plan(serving.top_delayed(serving.road_states(registry.ev(spark, SF))))
    assert "TakeOrderedAndProject" in board and "props" not in board


def test_unused_columns_leave_the_count_window(spark):
    rows = enrich.count_window(registry.ev(spark, SF)).select("seq", "rolling_avg_speed_3")
    text = plan(rows)
    assert "latitude" not in text and "props" not in text


def test_longterm_features_scan_once_and_never_join_events(spark):
    text = plan(features.longterm_features(registry.ev(spark, SF)))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    # The events and the one-row cutoff.
    assert len(re.findall("FileScan", text)) == 2
    given = plan(features.longterm_features(registry.ev(spark, SF), "2024-01-30 00:00:00"))
    assert len(re.findall("FileScan", given)) == 1 and "Join" not in given


def test_latest_row_reduces_before_the_shuffle(spark):
    text = plan(registry.latest_predictions(spark, SF))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_asof_is_not_a_range_join(spark):
    text = plan(registry.asof_training_set(spark, SF))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_offset_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(9).selectExpr("CAST(id % 3 AS INT) AS partition", "id AS offset").write.parquet(path)
    text = plan(topics.offset_range_scan(spark.read.parquet(path), {0: 2}, {0: 5, 1: 7}))
    assert re.search(r"PushedFilters: \[Or\(And\(", text)


def test_partition_date_prunes(spark, tmp_path):
    from roadstate.operators.projections import trailing

    path = str(tmp_path / "t")
    df = frame(spark, [record(i, minute=1440 * i) for i in range(5)]).withColumn("dt", F.to_date("event_ts"))
    df.write.partitionBy("dt").parquet(path)
    cutoff = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    text = plan(trailing(spark.read.parquet(path), "event_ts", cutoff, 2))
    assert re.search(r"PartitionFilters: \[.*dt.*2024-01-03", text)


def test_split_plan_broadcasts_only_keys(spark):
    events = registry.ev(spark, SF)
    layout = SeriesLayout.measure(events, ROUTE_KEYS, ("seq",), max_rows=60)
    assert layout.split
    text = plan(enrich.enrich_series(events, layout=layout))
    below = text.split("- BroadcastExchange")[1:]  # reused ones have no subtree
    assert below
    for part in below:
        # The hot keys are driver-side rows; no file is read below a broadcast.
        first = re.search(r"FileScan|ExistingRDD|LocalTableScan", part)
        assert first and first.group() != "FileScan"


def test_counters_see_every_route(spark):
    """More routes than the board has lines: only the board itself is cut."""
    rows = [record(i, f"R{i:04d}", 0, 5.0, accidents=i % 2) for i in range(1200)]
    missing = [c for c in serving.BOARD_VALUES if c not in rows[0]]
    events = frame(spark, rows).withColumns({c: F.lit(None).cast("double") for c in missing})
    assert serving.road_status_board(events).count() == 500
    counted = serving.status_counters(serving.road_states(events)).first()
    assert (counted["accident_roads"], counted["problem_roads"]) == (600, 1200)
