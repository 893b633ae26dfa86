"""Carried-state streams over several micro-batches, with hot keys, restarts and replays."""

import random

import models
import pytest
from conftest import RECORD, frame, rows_of
from pyspark.sql import functions as F
from test_streaming import SCHEMA, stories

from roadstate import adapters
from roadstate.operators import enrich, rules
from roadstate.plans import registry
from roadstate.schemas import AREA_KEYS, LAG_COLUMNS, ROUTE_KEYS, WEATHER
from roadstate.streaming import carried, jobs

FILES = 5


def source(spark, rows, tmp_path, name, per_trigger=1):
    """Rows in arrival files; ``hot`` holds about half of them."""
    path = carried.arrival_copy(frame(spark, rows, SCHEMA).repartition(3), str(tmp_path / f"{name}-in"), ["seq"], FILES)
    return spark.readStream.schema(frame(spark, rows[:1], SCHEMA).schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def job(spark, tmp_path, steps, name, **more):
    table = carried.BatchTable(spark, str(tmp_path / name), str(tmp_path / f"{name}-manifest"))
    return carried.CarriedJob(steps, table, str(tmp_path / f"{name}-job"), **more)


def run(spark, rows, tmp_path, steps, name, shape=lambda s: s):
    made = job(spark, tmp_path, steps, name)
    query = made.start(shape(source(spark, rows, tmp_path, name)))
    query.awaitTermination()
    assert query.exception() is None
    out = spark.read.parquet(made.table.path)
    assert out.select("batch").distinct().count() > 1
    return out.drop("batch")


@pytest.mark.parametrize("max_rows", [1_000_000, 6])
def test_congestion(spark, tmp_path, max_rows):
    rows = stories()
    out = run(spark, rows, tmp_path, [carried.Congestion(max_rows=max_rows)], "congestion")
    batch = rules.congestion_alerts(frame(spark, rows))
    assert batch.count() > 10 and rows_of(out, *batch.columns) == rows_of(batch)


@pytest.mark.parametrize("max_rows", [4, 1000])
def test_one_run_over_all_batches(spark, tmp_path, max_rows):
    rows = [r | {"avg_speed": 5.0, "road_name": "hot" if i % 7 else f"R{i}"} for i, r in enumerate(stories())]
    out = run(spark, rows, tmp_path, [carried.Congestion(max_rows=max_rows)], "run")
    expected = models.congestion(rows)
    got = out.select(
        "seq", "low_speed_event_count", "low_speed_duration_minutes", "matched_by.consecutive_events", "matched_by.duration", "severity"
    )
    assert sorted(map(tuple, got.collect())) == expected and max(r[1] for r in expected) > 100


@pytest.mark.parametrize("max_rows", [1_000_000, 6])
def test_accident(spark, tmp_path, max_rows):
    rows = stories()
    out = run(spark, rows, tmp_path, [carried.Accidents(max_rows=max_rows)], "accident")
    batch = rules.accident_alerts(frame(spark, rows))
    assert batch.count() > 10 and rows_of(out, *batch.columns) == rows_of(batch)


@pytest.mark.parametrize("max_rows", [1_000_000, 6])
def test_windows(spark, tmp_path, max_rows):
    rows = stories()
    out = run(spark, rows, tmp_path, [carried.Windows(emit_order="emitted", max_rows=max_rows)], "windows")
    got = out.select("emitted", "seq", "prev_avg_speed_1", "prev_avg_speed_2", "prev_avg_speed_3", F.round("rolling_avg_speed_3", 6))
    assert sorted(map(tuple, got.collect())) == models.lags_and_window(rows)
    batch = enrich.enrich_series(frame(spark, rows), emit_order="emitted")
    columns = ["emitted", "seq", "timestamp", "vehicle_count", *LAG_COLUMNS]
    assert rows_of(out, *columns) == rows_of(batch, *columns)


def sides(s):
    return carried.Fill.both(adapters.sensor_part(s), s.where("event_type = 'signup'"), AREA_KEYS, ["seq"], WEATHER)


@pytest.mark.parametrize("max_rows", [1_000_000, 6])
def test_fill(spark, tmp_path, max_rows):
    rows = stories()
    rows = [r | {"district": "Demo" if i % 3 else f"D{i % 5}"} for i, r in enumerate(rows)]
    out = run(spark, rows, tmp_path, [carried.Fill(present="present", max_rows=max_rows)], "fill", sides)
    df = frame(spark, rows, SCHEMA)
    batch = enrich.latest_fill(adapters.sensor_part(df), df.where("event_type = 'signup'"), present="present")
    columns = ["seq", *WEATHER]
    assert rows_of(out, *columns) == rows_of(batch, *columns)


def test_state_is_small_and_old_versions_go(spark, tmp_path):
    rows = stories(rows=300)
    run(spark, rows, tmp_path, [carried.Windows()], "small")
    state = tmp_path / "small-job" / "state-0"
    versions = sorted(p.name for p in state.iterdir())
    assert versions == [f"version={FILES - 2}", f"version={FILES - 1}"]
    last = spark.read.parquet(str(state / versions[-1]))
    assert last.groupBy("road_name").count().agg(F.max("count")).first()[0] == 5


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("lost_after", ["rows", "state"])
def test_replayed_batch_changes_nothing(spark, tmp_path, lost_after, monkeypatch):
    """The third micro-batch fails after its rows (or its state) are written, and is run again."""
    rows = stories()
    stream = source(spark, rows, tmp_path, "replay")
    made = job(spark, tmp_path, [carried.Congestion(max_rows=6)], "replay")
    failures = []
    kind = carried.BatchTable if lost_after == "rows" else carried.StateTable
    write = kind.write

    def failing(self, batch_id, df):
        write(self, batch_id, df)
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise Lost

    monkeypatch.setattr(kind, "write", failing)
    with pytest.raises(Exception, match="Lost"):
        made.start(stream).awaitTermination()
    files = {p for p in (tmp_path / "replay").rglob("*.parquet")}
    made.start(stream).awaitTermination()
    assert failures == [2] and files <= {p for p in (tmp_path / "replay").rglob("*.parquet")}
    batch = rules.congestion_alerts(frame(spark, rows))
    assert rows_of(spark.read.parquet(made.table.path), *batch.columns) == rows_of(batch)


def test_missing_state_is_an_error(spark, tmp_path):
    state = carried.StateTable(spark, str(tmp_path / "state"))
    assert state.before(0) is None
    with pytest.raises(RuntimeError, match="no state"):
        state.before(3)


def test_consumer_sees_whole_batches_in_order(spark, tmp_path):
    rows = stories()
    first = job(spark, tmp_path, [carried.Windows(emit_order="emitted")], "first")
    first.start(source(spark, rows, tmp_path, "first")).awaitTermination()
    schema = spark.read.parquet(first.table.path).drop("batch").schema
    # A batch in the middle of being written is not in the manifest.
    spark.read.parquet(f"{first.table.path}/batch=0").write.parquet(f"{first.table.path}/batch=99")
    second = job(
        spark, tmp_path, [carried.Congestion(order=("emitted",), max_rows=6)], "second",
        source=lambda names: first.table.load(names, schema),
    )
    second.start(first.table.stream(2)).awaitTermination()
    whole = enrich.enrich_series(frame(spark, rows), emit_order="emitted")
    batch = rules.congestion_alerts(whole, order=("emitted",))
    assert rows_of(spark.read.parquet(second.table.path), *batch.columns) == rows_of(batch)


def pipeline(spark, tmp_path, name, folder, weather, **more):
    schema = frame(spark, stories()[:1], SCHEMA).schema
    read = lambda s, p: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(p)
    sensors = adapters.sensor_part(read(schema, folder))
    updates = read(schema, weather).where("event_type = 'signup'").select("seq", "district", "city", *WEATHER)
    return jobs.Pipeline(spark, str(tmp_path / name), sensors, updates, present="present", **more)


def test_pipeline_stopped_half_way_equals_one_run(spark, tmp_path):
    rows = stories(rows=120)
    random.Random(1).shuffle(rows)
    rows = [r | {"seq": i} for i, r in enumerate(rows)]
    df = frame(spark, rows, SCHEMA)
    folders = [str(tmp_path / "all"), str(tmp_path / "grown")]
    halves = [df.where("seq < 50"), df.where("seq >= 50")]
    outputs = []
    for name, folder in zip(("whole", "parts"), folders, strict=True):
        for i, half in enumerate(halves):
            carried.arrival_copy(half, f"{folder}/part{i}", ["seq"], 2)
            pipe = pipeline(spark, tmp_path, name, folder, folder)
            if name == "parts":
                # The consumers of the first half never start: the second run catches up.
                pipe.start_enrich(once=True).awaitTermination()
                pipe = pipeline(spark, tmp_path, name, folder, folder)
        pipe.run_once()
        pipe.run_once()
        outputs.append(
            [
                rows_of(spark.read.parquet(pipe.path(t)).drop("batch", "raw_message"))
                for t in ("enriched_events", "traffic_alerts", "traffic_predictions")
            ]
        )
    assert all(outputs[0]) and outputs[0] == outputs[1]


def test_tasks_share_a_micro_batch_of_the_columns_a_step_needs(spark, monkeypatch):
    monkeypatch.setattr(registry, "ROWS_PER_FILE", 70, raising=False)
    seen = []

    class Watching(carried.Congestion):
        def __call__(self, batch, before):
            seen.append((batch.rdd.getNumPartitions(), set(batch.columns)))
            return super().__call__(batch, before)

    registry.finished(spark, registry.arrivals(spark, "/root/testdata/sf0.001"), [Watching()], "watched")
    assert len(seen) == registry.LEAST_BATCHES
    for tasks, columns in seen:
        assert tasks > 1
        assert columns == {"seq", *ROUTE_KEYS, "timestamp", "avg_speed", "vehicle_count"}
