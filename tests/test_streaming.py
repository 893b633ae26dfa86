"""Streams in several micro-batches against the batch form, with a restart."""

import random

import models
import pytest
from conftest import RECORD, frame, record, rows_of
from pyspark.sql import functions as F

from roadstate import adapters
from roadstate.operators import enrich, rules
from roadstate.plans import registry
from roadstate.schemas import LAG_COLUMNS, ROLLING_COLUMNS
from roadstate.streaming import jobs

FILES = 4
SCHEMA = RECORD + ", event_type string, temperature_celsius double, humidity_percentage double, weather_condition string, is_rain int"


def stories(seed=11, rows=160):
    rng = random.Random(seed)
    return [
        record(
            i, rng.choice(["hot", "hot", "R1", "R2", "R3"]), minute=rng.randrange(0, 2000, 5),
            speed=rng.choice([None, 3.0, 7.0, 9.0, 30.0]), volume=rng.randrange(100), accidents=rng.choice([0, 0, 0, 1, 2]),
            event_type="signup" if i % 9 == 0 else "view",
            temperature_celsius=rng.choice([10.0, 20.0, None]), humidity_percentage=50.0,
            weather_condition=rng.choice(["Rain", None]), is_rain=rng.choice([0, 1]),
        )
        for i in range(rows)
    ]


def write_files(spark, rows, folder, first, last):
    """Arrival order is cut into files; inside a file rows are shuffled."""
    step = -(-len(rows) // FILES)
    for i in range(first, last):
        part = rows[i * step : (i + 1) * step]
        random.Random(i).shuffle(part)
        frame(spark, part, SCHEMA).coalesce(2).write.mode("append").parquet(f"{folder}/part{i}")


def run_twice(spark, rows, tmp_path, build, name):
    """Half of the files, stop, then the rest from the same checkpoint."""
    source, target, mark = (str(tmp_path / f"{name}-{n}") for n in ("in", "out", "mark"))
    schema = frame(spark, rows[:1], SCHEMA).schema
    for first, last in ((0, 2), (2, FILES)):
        write_files(spark, rows, source, first, last)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 2)
        out = build(stream.parquet(source))
        query = jobs.write_stream(out, target, mark)
        query.awaitTermination()
        assert query.exception() is None
    return spark.read.schema(out.schema).parquet(target)


def test_congestion_stream(spark, tmp_path):
    rows = stories()
    out = run_twice(spark, rows, tmp_path, jobs.congestion_alerts_stream, "congestion")
    batch = rules.congestion_alerts(frame(spark, rows))
    assert batch.count() > 10
    assert rows_of(out) == rows_of(batch.select(*out.columns))


def test_accident_stream(spark, tmp_path):
    rows = stories()
    out = run_twice(spark, rows, tmp_path, jobs.accident_alerts_stream, "accident")
    batch = rules.accident_alerts(frame(spark, rows))
    assert batch.count() > 10
    assert rows_of(out) == rows_of(batch.select(*out.columns))


def test_enrich_stream(spark, tmp_path):
    rows = stories()
    out = run_twice(
        spark, rows, tmp_path,
        lambda s: jobs.enrich_stream(s.select(*frame(spark, rows[:1]).columns), emit_order="emitted"), "enrich",
    )
    got = [
        tuple(r) for r in out.select(
            "emitted", "seq", "prev_avg_speed_1", "prev_avg_speed_2", "prev_avg_speed_3", F.round("rolling_avg_speed_3", 6)
        ).collect()
    ]
    assert sorted(got) == models.lags_and_window(rows)
    batch = enrich.enrich_series(frame(spark, rows), emit_order="emitted")
    columns = ["emitted", "seq", "timestamp", "vehicle_count", *LAG_COLUMNS]
    assert rows_of(out, *columns) == rows_of(batch, *columns)
    for c in ROLLING_COLUMNS:
        pairs = zip(
            out.orderBy("emitted", "road_name").select(c).collect(), batch.orderBy("emitted", "road_name").select(c).collect(), strict=True
        )
        assert all(models.same(a[0], b[0]) or a[0] == pytest.approx(b[0]) for a, b in pairs)


def test_fill_stream(spark, tmp_path):
    rows = stories()
    build = lambda s: jobs.latest_fill_stream(
        adapters.sensor_part(s), s.where("event_type = 'signup'"), present="present"
    )
    out = run_twice(spark, rows, tmp_path, build, "fill")
    df = frame(spark, rows, SCHEMA)
    batch = enrich.latest_fill(adapters.sensor_part(df), df.where("event_type = 'signup'"), present="present")
    columns = ["seq", "accident_count", "temperature_celsius", "humidity_percentage", "weather_condition", "is_rain"]
    assert rows_of(out, *columns) == rows_of(batch, *columns)


def test_pipeline_golden_scenarios(spark, tmp_path):
    """Both scenarios through the whole chain: one alert of each kind."""
    rows = [record(i, "CEP", minute=15 * i, speed=7.0, volume=420 + 30 * i) for i in range(5)]
    rows += [
        record(10 + i, "ACC", minute=15 * i, speed=s, volume=v, accidents=a)
        for i, (s, v, a) in enumerate([(28, 260, 0), (24, 300, 0), (9, 480, 2)])
    ]
    source = str(tmp_path / "sensors")
    frame(spark, rows).write.parquet(source)
    none = str(tmp_path / "weather")
    weather_schema = "seq long, district string, city string, accident_count long, temperature_celsius double, humidity_percentage double, weather_condition string, is_rain int"
    frame(spark, [], weather_schema).write.parquet(none)
    stream = lambda path, schema: spark.readStream.schema(schema).parquet(path)
    sensors = stream(source, frame(spark, rows).schema).withColumns(
        {"temperature_celsius": F.lit(28.0), "humidity_percentage": F.lit(70.0), "weather_condition": F.lit("Clear"), "is_rain": F.lit(0)}
    )
    pipe = jobs.Pipeline(
        spark, str(tmp_path / "run"), sensors, stream(none, frame(spark, [], weather_schema).schema),
        load_model=registry.fixed_model,
    )
    pipe.run_once()
    pipe.run_once()  # nothing new: nothing changes
    enriched = spark.read.parquet(pipe.path("enriched_events"))
    assert rows_of(enriched, "seq") == [(12,), (2,), (3,), (4,)] or sorted(r[0] for r in enriched.select("seq").collect()) == [2, 3, 4, 12]
    alerts = spark.read.parquet(pipe.path("traffic_alerts"))
    assert rows_of(alerts, "alert_category", "road_name", "severity") == [
        ("accident", "ACC", "high"), ("congestion", "CEP", "medium"),
    ]
    predictions = spark.read.parquet(pipe.path("traffic_predictions"))
    assert predictions.count() == 4
    assert predictions.where("model_status = 'loaded' AND predicted_traffic_status <> ''").count() == 4


def test_score_without_model(spark):
    from roadstate.operators.scoring import score

    got = score(frame(spark, [record(0)]), None, None).first()["prediction_30m"]
    assert got["model_status"] == "unavailable" and got["forecast_horizon_minutes"] == 30
    assert got["current_cluster"] is None
