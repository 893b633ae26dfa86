"""Tables by name, the offset ledger, alias numbers, snapshot versions, refresh while scoring."""

import uuid
from datetime import date, datetime

import pytest
from conftest import frame, record, rows_of
from pyspark.sql import functions as F
from test_sources import lake

from roadstate.operators import scoring
from roadstate.plans import registry
from roadstate.schemas import LONGTERM_FEATURES, LONGTERM_SCHEMA
from roadstate.sources import ledger, models, online, tables
from roadstate.streaming import jobs


@pytest.fixture
def named(spark, tmp_path):
    database = f"t_{uuid.uuid4().hex[:8]}"
    tables.ensure_tables(spark, str(tmp_path / "lake"), database)
    yield {name: tables.lake_table(spark, name, database) for name in tables.TABLES}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_reader_by_name_sees_every_insert(spark, named):
    table = named["enriched_events"]
    rows = lake(spark, 30, lambda i: "bad" if i % 5 == 0 else f"2024-01-0{1 + i % 3}T00:00:00")
    assert table.rows().count() == 0 and table.partition_by == ["dt"]
    assert tables.insert_only(rows.where("source_offset < 6"), table) == 18
    keys = ["source_partition", "source_offset", "avg_speed", "event_ts", "dt"]
    assert rows_of(spark.table(table.name), *keys) == rows_of(rows.where("source_offset < 6"), *keys)
    for _ in range(2):
        tables.insert_only(rows, table)
        assert rows_of(spark.table(table.name), *keys) == rows_of(rows, *keys)
    days = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()}
    assert len(days) == rows.select("dt").distinct().count()


def test_partitions_written_to_the_folder_are_registered(spark, named, tmp_path):
    table = named["enriched_events"]
    rows = lake(spark)
    tables.insert_only(rows, str(tmp_path / "lake" / "enriched_events"))
    table.register()
    assert table.rows().count() == 30
    tables.insert_only(rows, table)
    assert table.rows().count() == 30


def features_of(spark, rows):
    """(route, cutoff, day, value) as feature rows."""
    full = [
        tuple({"road_name": r, "district": "d", "city": "c", "hour": 1, "day_of_week": 2, "baseline_speed_7d": v,
               "source_cutoff": cut, "dt": day}.get(f.name) for f in LONGTERM_SCHEMA)
        for r, cut, day, v in rows
    ]
    return spark.createDataFrame(full, LONGTERM_SCHEMA)


def test_replace_moves_a_key_between_partitions(spark, named):
    table = named["longterm_features"]
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    a, b, c = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    shown = ["road_name", "source_cutoff", "dt", "baseline_speed_7d"]
    stored = [("r", one, a, 1.0), ("s", one, b, 2.0), ("r", two, b, 3.0), ("s", None, a, 4.0), ("t", two, None, 5.0)]
    table.append(features_of(spark, stored))
    new = [("r", one, c, 6.0), ("q", None, None, 7.0)]
    for _ in range(2):  # a rerun changes nothing
        table.replace(features_of(spark, new), "source_cutoff")
        kept = [r for r in stored if r[1] == two]
        assert rows_of(table.rows(), *shown) == sorted(kept + new, key=repr)
    left = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()}
    assert left == {"dt=2024-01-02", "dt=2024-01-03", "dt=__HIVE_DEFAULT_PARTITION__"}
    table.replace(features_of(spark, []), "source_cutoff")
    assert table.rows().count() == 4


def messages(spark, ends):
    rows = [(p, o, float(o)) for p, end in ends.items() for o in range(5, end)]
    return spark.createDataFrame(rows, "partition int, offset long, avg_speed double")


def test_replace_in_a_session_with_static_overwrites(spark, named):
    table, name = named["longterm_features"], "spark.sql.sources.partitionOverwriteMode"
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    before = spark.conf.get(name)
    spark.conf.set(name, "static")
    try:
        table.append(features_of(spark, [("a", first, first.date(), 1.0), ("b", second, second.date(), 2.0)]))
        table.replace(features_of(spark, [("a", first, first.date(), 3.0)]), "source_cutoff")
        assert spark.conf.get(name) == "static"
    finally:
        spark.conf.set(name, before)
    assert rows_of(table.rows(), "road_name", "baseline_speed_7d") == [("a", 3.0), ("b", 2.0)]


def test_ledger_moves_after_the_merge_only(spark, tmp_path):
    book = ledger.OffsetLedger(spark, str(tmp_path / "ledger"))
    merged = []

    def merge(rows):
        merged.append(sorted((r.partition, r.offset) for r in rows.collect()))

    def failing(rows):
        raise RuntimeError("store is down")

    assert book.stored({0: 5}) == {0: 5}
    assert ledger.ingest_offsets(messages(spark, {}), book, merge) == 0
    assert ledger.ingest_offsets(messages(spark, {0: 8, 1: 6}), book, merge) == 4
    with pytest.raises(RuntimeError):
        ledger.ingest_offsets(messages(spark, {0: 10, 1: 6}), book, failing)
    assert book.stored({}) == {0: 8, 1: 6}
    assert ledger.ingest_offsets(messages(spark, {0: 10, 1: 6, 2: 7}), book, merge) == 4
    assert ledger.ingest_offsets(messages(spark, {0: 10, 1: 6, 2: 7}), book, merge) == 0
    assert merged == [[(0, 5), (0, 6), (0, 7), (1, 5)], [(0, 8), (0, 9), (2, 5), (2, 6)]]
    assert rows_of(book.runs(), "run", "partition", "n_records") == [(1, 0, 3), (1, 1, 1), (2, 0, 2), (2, 1, 0), (2, 2, 2)]
    assert rows_of(book.runs(), "start_offset", "end_offset")[0] == (5, 6)


@pytest.mark.parametrize("text", ["no json", '{"partition": 0}', "[1]", '{"partition": null, "end_offset": 3}'])
def test_unreadable_ledger_gives_the_defaults(spark, tmp_path, text):
    book = ledger.OffsetLedger(spark, str(tmp_path / "ledger"))
    book.commit({0: 0}, {0: 9})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{book.path}/run=2")
    assert book.stored({0: 4, 1: 5}) == {0: 4, 1: 5}
    assert book.commit({0: 4}, {0: 12}) == 3 and book.stored({1: 5}) == {0: 12, 1: 5}


def test_alias_of_two_publications_at_one_time(spark, tmp_path):
    root, at = str(tmp_path / "models"), datetime(2024, 1, 1)
    model = registry.fixed_model()
    assert models.current_alias(spark, root) is None and models.load_model(spark, root) is None
    for i, run in enumerate(("b", "a", "c")):
        models.publish_model(spark, model, root, run, published_at=at)
        assert models.current_alias(spark, root).asDict() | {"path": None} == {
            "alias": "champion", "run_id": run, "path": None, "published_at": at, "number": i + 1,
        }
    with pytest.raises(models.AliasMoved):
        models.publish_model(spark, model, root, "late", expected=2)
    # A publication that took number 4 but has not moved the alias yet.
    assert models._created(spark, f"{root}/claims/champion/4")
    with pytest.raises(models.AliasMoved):
        models.publish_model(spark, model, root, "late", expected=3)
    models.publish_model(spark, model, root, "d", published_at=at)
    assert models.current_alias(spark, root).number == 5


def test_missing_files_of_a_version_count_as_no_model(spark, tmp_path):
    root = str(tmp_path / "models")
    models.publish_model(spark, registry.fixed_model(), root, "r")
    (tmp_path / "models" / "versions" / "r" / "transitions").rename(tmp_path / "gone")
    assert models.load_model(spark, root) is None


def test_snapshot_versions(spark, tmp_path):
    table = online.SnapshotTable(spark, str(tmp_path / "snapshots"))
    assert table.newest() is None and table.load() is None
    df = spark.createDataFrame([("k", 1.0)], "feature_key string, baseline_speed_7d double")
    assert [table.publish(df), table.publish(df.withColumn("baseline_speed_7d", F.lit(2.0)))] == [1, 2]
    (tmp_path / "snapshots" / "version=3").mkdir()  # being written
    assert table.newest() == 2 and table.load().first()[1] == 2.0 and table.load(1).first()[1] == 1.0


def test_scorer_refreshes_by_records_and_version(spark):
    asked, version = [], {"model": 1, "snapshot": 1}
    scorer = jobs.Scorer(
        lambda: asked.append("snapshot"), lambda: asked.append("model"),
        lambda: version["snapshot"], lambda: version["model"], refresh_records=10,
    )
    batch = frame(spark, [record(i) for i in range(4)]).cache()
    status = lambda: scorer(batch).first()["prediction_30m"]["model_status"]
    assert status() == "unavailable" and asked == ["model", "snapshot"]
    version["model"] = 2
    status(), status()  # 4 and 8 records before
    assert asked == ["model", "snapshot"]
    version["snapshot"] = 2
    status()  # 12 before: past 10
    assert asked == ["model", "snapshot", "model", "snapshot"]
    version["model"] = 3
    status()
    assert asked[4:] == []
    with pytest.raises(ValueError):
        jobs.Scorer(lambda: None, lambda: None, refresh_records=0)


def test_lookup_by_route_equals_lookup_by_event(spark):
    rows = [record(i, road) | {"hour": h, "day_of_week": d} for i, (road, h, d) in enumerate(
        [("R 1", 7, 1), ("r-1", 7, 1), (None, 23, None), ("Đường", None, 6), ("Duong", 0, 6)] * 2
    )]
    events = frame(spark, rows)
    keyed = events.select(registry.online_key().alias("feature_key")).distinct()
    snapshot = keyed.withColumns(
        {c: F.length("feature_key").cast("double") for c in LONGTERM_FEATURES} | {"source_cutoff": F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")}
    )
    by_event = scoring.with_online_features(events, snapshot)
    by_route = scoring.with_online_features(events, snapshot, events.select("road_name", "district", "city").distinct())
    assert by_event.where("baseline_speed_7d IS NULL").isEmpty()
    assert rows_of(by_route.select(*by_event.columns)) == rows_of(by_event)


def test_work_is_cleared_when_asked(spark):
    from pathlib import Path

    from roadstate import session

    kept = session._TAKEN[:]
    session._TAKEN.clear()
    try:
        path = session.work_dir(spark, "cleared")
        spark.range(3).write.parquet(path)
        session.work_dir(spark, "never-written")
        assert Path(path).exists() and session.clear_work(spark) == 1 and not Path(path).exists()
        assert session.clear_work(spark) == 0
    finally:
        session._TAKEN += kept
