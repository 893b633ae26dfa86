"""Tables, topics, online store, models: idempotence and bounds."""

import json
from datetime import date, datetime, timedelta

import pytest
from conftest import SF, frame, record, rows_of
from pyspark.sql import functions as F

from roadstate import adapters
from roadstate.operators import clusters, enrich, features, projections, training
from roadstate.plans import registry
from roadstate.schemas import ENRICHED_COLUMNS, ENRICHED_SCHEMA, LONGTERM_FEATURES, MODEL_FEATURES, ROUTE_KEYS, SENSOR_SCHEMA, TOPIC_SCHEMA
from roadstate.sources import files, models, online, tables, topics


def test_contract_widths():
    assert len(ENRICHED_COLUMNS) == 48
    assert len(TOPIC_SCHEMA) == 42
    assert len(MODEL_FEATURES) == 35


def lake(spark, n=30, text=lambda i: f"2024-01-0{1 + i % 3}T00:00:00"):
    rows = [(f"R{i % 4}", "d", "c", text(i), i % 3, i // 3, float(i)) for i in range(n)]
    df = spark.createDataFrame(
        rows, "road_name string, district string, city string, timestamp string, partition int, offset long, avg_speed double"
    )
    return registry.lake_rows(df)


def test_insert_only_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    # Every fifth time is bad, so those rows have no date.
    rows = lake(spark, 30, lambda i: "bad" if i % 5 == 0 else f"2024-01-0{1 + i % 3}T00:00:00")
    tables.insert_only(rows.where("source_offset < 6"), target)
    for _ in range(2):
        tables.insert_only(rows, target)
    stored = tables.read_or_none(spark, target, ENRICHED_SCHEMA)
    keys = ["source_partition", "source_offset", "avg_speed", "event_ts"]
    assert rows_of(stored, *keys) == rows_of(rows, *keys)


def test_replace_by_key_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    tables.replace_by_key(df, target, "k")
    tables.replace_by_key(df.where("k = 'a'"), target, "k")
    assert rows_of(spark.read.parquet(target), "k", "v") == [("a", 1), ("a", 2), ("b", 3)]
    tables.replace_by_key(spark.createDataFrame([("a", 9)], "k string, v int"), target, "k")
    assert rows_of(spark.read.parquet(target), "k", "v") == [("a", 9), ("b", 3)]


def test_ensure_tables_twice(spark, tmp_path):
    first = tables.ensure_tables(spark, str(tmp_path), "traffic_test")
    assert tables.ensure_tables(spark, str(tmp_path), "traffic_test") == first
    described = spark.table(first[0])
    assert set(described.columns) == set(ENRICHED_COLUMNS)
    spark.sql("DROP DATABASE traffic_test CASCADE")


def test_json_array(spark, tmp_path):
    full, empty = tmp_path / "full.json", tmp_path / "empty.json"
    full.write_text(json.dumps([{"road_name": "R", "avg_speed": 1.5}, {"road_name": "S"}]))
    empty.write_text("[]")
    df = files.read_json_array(spark, str(full), SENSOR_SCHEMA)
    assert rows_of(df, "road_name", "avg_speed") == [("R", 1.5), ("S", None)]
    with pytest.raises(ValueError):
        files.read_json_array(spark, str(empty), SENSOR_SCHEMA)


def messages(spark, values):
    rows = [(v.encode(), "t", i % 3, i // 3, datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset long, timestamp timestamp")


def test_topic_view_and_rejects(spark):
    source = messages(
        spark, ['{"road_name":"Đường","vehicle_count":3,"is_rain":null}', "oops", '{"vehicle_count":"x"}']
    )
    good = topics.read_topic(spark, "t", TOPIC_SCHEMA, source=source)
    row = good.first()
    assert good.count() == 1
    assert (row["road_name"], row["vehicle_count"], row["partition"], row["offset"]) == ("Đường", 3, 0, 0)
    assert sorted(row["present"]) == ["is_rain", "road_name", "vehicle_count"]
    bad = topics.rejected_rows(spark, "t", TOPIC_SCHEMA, source=source)
    assert rows_of(bad, "raw_message") == [("oops",), ('{"vehicle_count":"x"}',)]


def test_messages_round_trip(spark):
    df = frame(spark, [record(0, "Đường", speed=None)])
    sent = topics.as_messages(df).first()
    assert sent["key"] == "Đường|Demo|Ha Noi"
    body = json.loads(sent["value"])
    assert body["road_name"] == "Đường" and body["avg_speed"] is None
    assert ": " not in sent["value"]


def test_offset_ranges(spark):
    df = spark.range(30).select((F.col("id") % 3).cast("int").alias("partition"), F.expr("id div 3").alias("offset"))
    got = topics.offset_range_scan(df, {0: 4, 1: 9}, {0: 6, 1: 9, 2: 2})
    assert rows_of(got) == [(0, 4), (0, 5), (2, 0), (2, 1)]
    assert topics.offset_range_scan(df, {0: 5}, {0: 5}).isEmpty()


def history(spark, writes):
    rows = [
        {**record(0, road), "source_cutoff": at, **dict.fromkeys(LONGTERM_FEATURES), "baseline_speed_7d": base,
         "avg_speed_hour_dow_4w": slot}
        for road, at, base, slot in writes
    ]
    values = ", ".join(f"{f} double" for f in LONGTERM_FEATURES)
    return frame(
        spark, rows,
        f"road_name string, district string, city string, hour int, day_of_week int, source_cutoff timestamp_ntz, {values}",
    )


def test_online_snapshot_rules(spark):
    t0 = datetime(2024, 1, 1)
    at = lambda s: t0 + timedelta(seconds=s)
    df = history(
        spark,
        [
            ("A", at(0), 1.0, 5.0), ("A", at(60), 2.0, None),  # an older non-null value survives
            ("B", at(0), 1.0, 5.0), ("B", at(90_060), 2.0, None),  # lapsed in between
            ("C", at(0), 3.0, 3.0),  # lapsed at the end
            ("Đ x", at(90_060), 1.0, None), ("D-x", at(90_060), 7.0, None),  # one slug
        ],
    )
    def state(**options):
        found = features.online_snapshot(df, **options)
        return {r["feature_key"].split(":")[4]: (r["baseline_speed_7d"], r["avg_speed_hour_dow_4w"]) for r in found.collect()}

    at_end = state()
    assert at_end["b"] == (2.0, None) and "c" not in at_end
    assert at_end["d_x"] == (1.0, None)  # "Đ x" sorts after "D-x"
    assert state(as_of=at(90_000))["a"] == (2.0, 5.0)
    assert state(as_of=at(90_000), carry_forward=False)["a"] == (2.0, None)
    row = features.online_snapshot(df).where("feature_key LIKE '%:b:%'").first()
    assert row["feature_key"] == "traffic:longterm:ha_noi:demo:b:h00:dow0"


def test_publish_online(spark, tmp_path):
    snapshot = features.online_snapshot(history(spark, [(f"R{i}", datetime(2024, 1, 1), 1.0, None) for i in range(25)]))
    folder = str(tmp_path)

    def writer(batch, ttl):
        import json as j
        import os
        import uuid

        assert len(batch) <= 10 and ttl == 90_000
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
            j.dump(batch, out)

    online.publish_online(snapshot, writer, batch=10)
    sent = [entry for f in tmp_path.iterdir() for entry in json.loads(f.read_text())]
    assert len(sent) == 25
    assert all(set(fields) == {"baseline_speed_7d", "source_cutoff", "updated_at"} for _, fields in sent)


def training_rows(spark):
    records = projections.restamp(registry.ev(spark, SF).drop("hour", "day_of_week", "is_weekend", "is_peak_hour"))
    return training.training_set(enrich.enrich_series(records), features.longterm_features(records), "run 1")


def test_fit_publish_load(spark, tmp_path):
    rows = training_rows(spark).cache()
    assert rows.where("training_run_id = 'run-1'").count() == rows.count()
    model, states = clusters.fit_states(rows, restarts=2)
    assert sorted(p["status"] for p in model.profiles.values()) == ["clear", "congested", "moderate"]
    assert set(model.transitions) == {0, 1, 2}
    assert model.metrics["inertia"] > 0 and model.metrics["transition_rows"] > 0
    assert -1 <= model.metrics["silhouette_score"] <= 1
    assert states.where("cluster IS NULL").isEmpty()
    by_delay = sorted(model.profiles.values(), key=lambda p: p["avg_delay_minutes"])
    assert [p["status"] for p in by_delay] == ["clear", "moderate", "congested"]
    assert sum(p["samples"] for p in model.profiles.values()) == rows.count()

    root = str(tmp_path)
    assert models.load_model(spark, root) is None
    models.publish_model(spark, model, root, "a")
    models.publish_model(spark, registry.fixed_model(), root, "b")
    assert models.load_model(spark, root).transitions == dict(registry.fixed_model().transitions)
    models.publish_model(spark, model, root, "c")
    loaded = models.load_model(spark, root)
    assert loaded.transitions == model.transitions and loaded.profiles == model.profiles
    again = loaded.pipeline.transform(rows).withColumnRenamed("current_cluster", "cluster")
    assert rows_of(again, *ROUTE_KEYS, "event_ts", "cluster") == rows_of(states, *ROUTE_KEYS, "event_ts", "cluster")
    assert models.model_versions(spark, root).count() == 3


def test_fit_needs_rows_and_transitions(spark):
    rows = training_rows(spark).limit(2)
    with pytest.raises(clusters.NotEnoughRows):
        clusters.fit_states(rows)
    apart = training_rows(spark).where("minute(event_ts) = 0").limit(60)
    single = apart.dropDuplicates(ROUTE_KEYS)
    with pytest.raises(clusters.NotEnoughRows):
        clusters.fit_states(single, restarts=1)


def test_drain_takes_everything_whatever_the_batches(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    predictions = registry.predictions(spark, SF).limit(90).coalesce(1)
    for i in range(3):
        predictions.where(F.abs(F.hash("timestamp")) % 3 == i).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(predictions.schema).option("maxFilesPerTrigger", 1).parquet(source)
    drained = [tables.drain_to_parquet(stream, target, f"r:{run}", date(2024, 1, 1), mark) for run in range(2)]
    assert drained == [90, 0]
    assert spark.read.parquet(f"{target}/dt=2024-01-01").count() == 90


def test_route_part_of_online_keys_is_made_once_per_route(spark):
    records = adapters.traffic(spark, "/root/testdata/sf0.001")
    plain, keyed = (features.longterm_features(records, online=online) for online in (False, True))
    assert "online_route" not in plain.columns
    # The slugs stand below the generator of the grid, not above it.
    plan = features.online_snapshot(keyed)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan[: plan.index("Generate")]
    values = ["feature_key", "baseline_speed_7d", "avg_speed_hour_dow_4w", "written_at"]
    plain, keyed = (features.online_snapshot(df).select(values) for df in (plain, keyed))
    assert plain.count() > 0 and plain.exceptAll(keyed).isEmpty() and keyed.exceptAll(plain).isEmpty()
