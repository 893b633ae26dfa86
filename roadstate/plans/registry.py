"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import date, datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadstate import adapters
from roadstate.functions.scalars import online_key, route_key
from roadstate.functions.slugs import dash_slug, slug
from roadstate.operators import (
    aggregates,
    asof,
    clusters,
    enrich,
    features,
    normalize,
    projections,
    rules,
    scoring,
    training,
)
from roadstate.operators.series import SeriesLayout
from roadstate.plans import oracles, serving
from roadstate.schemas import (
    AREA_KEYS,
    CALENDAR,
    ENRICHED_SCHEMA,
    LAG_COLUMNS,
    LONGTERM_FEATURES,
    MODEL_FEATURES,
    ROLLING_COLUMNS,
    ROUTE_KEYS,
    TOPIC_ENRICHED,
    TOPIC_SCHEMA,
    WEATHER,
)
from roadstate.session import work_dir
from roadstate.sources import ledger, models, online, tables, topics
from roadstate.streaming import carried, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def near(c: Column) -> Column:
    """Four decimals, ties and last-bit noise going up in both engines."""
    return F.floor(c.cast("double") * 10000.0 + 0.50001) / 10000.0


def r4(*names: str) -> list[Column]:
    return [near(F.col(n)).alias(n) for n in names]


def text(*names: str) -> list[Column]:
    """Dates as text, which every client reads alike."""
    return [F.col(n).cast("string").alias(n) for n in names]


def numbers(df: DataFrame, *names: str) -> DataFrame:
    """Nullable integers as doubles, for the same reason."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def as_int(*names: str) -> list[Column]:
    return [F.col(n).cast("int").alias(n) for n in names]


ev = adapters.traffic


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose arrival order differs from their time order."""
    return ev(spark, sf_dir).withColumn("arrival", F.expr("seq + (seq % 7) * 40"))


LATE = ("arrival", "seq")


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.road_status_board(ev(spark, sf_dir))


# -- serving ---------------------------------------------------------------------


@query
def road_status_board(spark, sf_dir):
    return board(spark, sf_dir)


@query
def traffic_summary(spark, sf_dir):
    summary = serving.traffic_summary(ev(spark, sf_dir))
    return summary.withColumns({c: near(F.col(c)) for c in ("avg_speed", "avg_delay")})


@query
def status_counters(spark, sf_dir):
    return serving.status_counters(serving.road_states(ev(spark, sf_dir)))


@query
def top_delayed_roads(spark, sf_dir):
    return serving.top_delayed(serving.road_states(ev(spark, sf_dir)))


@query
def board_filtered(spark, sf_dir):
    rows = projections.filter_board(serving.road_states(ev(spark, sf_dir)), ["d1", "d2", "d7"], ["ACCIDENT", "CONGESTED"])
    return rows.select(*ROUTE_KEYS, "road_status", "avg_speed")


@query
def map_points(spark, sf_dir):
    return projections.map_points(serving.road_states(ev(spark, sf_dir)))


@query
def filter_options(spark, sf_dir):
    return projections.options(serving.road_states(ev(spark, sf_dir)), "district")


# -- projections -----------------------------------------------------------------


@query
def calendar_features(spark, sf_dir):
    return projections.with_calendar(ev(spark, sf_dir)).select("seq", *CALENDAR)


def sourced(events: DataFrame) -> DataFrame:
    """Events with the coordinates of a three-partition topic."""
    return events.withColumns(
        {"partition": F.col("seq") % 3, "offset": F.expr("seq div 3"), "topic": F.lit(TOPIC_ENRICHED)}
    )


@query
def event_time_lineage(spark, sf_dir):
    shown = F.when(F.col("seq") % 11 == 0, "bad time").otherwise(F.col("timestamp"))
    rows = sourced(ev(spark, sf_dir).withColumn("timestamp", shown))
    rows = projections.with_lineage(projections.with_event_time(rows))
    return rows.select(
        "seq", "timestamp", "event_ts", *text("dt"), "source_topic", "source_partition", "source_offset"
    )


@query
def timeline_restamp(spark, sf_dir):
    rows = ev(spark, sf_dir).select("seq", *ROUTE_KEYS, "avg_speed")
    return projections.restamp(rows)


@query
def first_seen_routes(spark, sf_dir):
    return enrich.first_seen(ev(spark, sf_dir), columns=["timestamp", "avg_speed"])


@query
def facet_merge(spark, sf_dir):
    records = ev(spark, sf_dir)
    facets = [projections.facet(records, name, "seq") for name in ("traffic", "vehicles", "weather")]
    layout = SeriesLayout.measure(records)
    return enrich.merge_facets(*facets, layout=layout).select(
        *ROUTE_KEYS, "position", "timestamp", "avg_speed", "vehicle_count", "hour", "truck_count", "car_ratio",
        "accident_count", "temperature_celsius", "weather_condition",
    )


@query
def route_slugs(spark, sf_dir):
    routes = ev(spark, sf_dir).select(*ROUTE_KEYS).distinct()
    name = F.concat(F.lit("Đ. Street  "), F.col("road_name"), F.lit("!"))
    plain = F.regexp_replace(name, "^Đ. ", "")
    return routes.select(
        *ROUTE_KEYS,
        route_key().alias("route_key"),
        slug(plain).alias("online_slug"),
        dash_slug(plain).alias("path_slug"),
    )


# -- enrichment ------------------------------------------------------------------


@query
def weather_latest_fill(spark, sf_dir):
    records = ev(spark, sf_dir)
    filled = enrich.latest_fill(
        adapters.sensor_part(records), adapters.weather_part(records), present="present"
    )
    return numbers(filled, "accident_count", "is_rain").select(
        "seq", *ROUTE_KEYS, "accident_count", "temperature_celsius", "humidity_percentage",
        "weather_condition", "is_rain",
    )


@query
def lag_features(spark, sf_dir):
    return enrich.with_lags(ev(spark, sf_dir)).select("seq", *ROUTE_KEYS, *LAG_COLUMNS)


@query
def rolling_count_window(spark, sf_dir):
    rows = enrich.count_window(late(spark, sf_dir), order=LATE)
    return rows.select("seq", *ROUTE_KEYS, "avg_speed", *r4(*ROLLING_COLUMNS))


ENRICHED_OUT = [
    "seq", *ROUTE_KEYS, "timestamp", "avg_speed", "vehicle_count", "accident_count", "temperature_celsius",
    "weather_condition", *LAG_COLUMNS,
]


@query
def enriched_events(spark, sf_dir):
    records = late(spark, sf_dir)
    filled = enrich.latest_fill(
        adapters.sensor_part(records), adapters.weather_part(records), present="present"
    )
    rows = enrich.enrich_series(filled, order=LATE, layout=SeriesLayout.measure(records, order=LATE))
    return numbers(rows, "accident_count").select(*ENRICHED_OUT, *r4(*ROLLING_COLUMNS))


LINEITEM_ORDER = (
    "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


@query
def lineitem_lags(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", *LINEITEM_ORDER)
    rows = enrich.with_lags(items, {"l_quantity": "prev_quantity"}, 3, ["l_partkey"], LINEITEM_ORDER)
    return rows.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity",
        "prev_quantity_1", "prev_quantity_2", "prev_quantity_3",
    )


# -- rules -----------------------------------------------------------------------


def flat_congestion(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "seq", "alert_type", "severity", *ROUTE_KEYS, "timestamp", "avg_speed", "vehicle_count",
        "low_speed_event_count", "low_speed_duration_minutes", "rule",
        F.col("matched_by.consecutive_events").alias("by_events"),
        F.col("matched_by.duration").alias("by_duration"),
    )


def flat_accident(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "seq", "alert_type", "severity", *ROUTE_KEYS, "timestamp", "accident_count",
        "history_avg_accident_count", "history_max_accident_count", "avg_speed", "vehicle_count", "rule",
        F.col("matched_by.first_accident_after_clean_history").alias("by_first"),
        F.col("matched_by.spike_vs_history").alias("by_spike"),
        F.col("matched_by.multi_accident").alias("by_multi"),
    )


@query
def congestion_alerts(spark, sf_dir):
    return flat_congestion(rules.congestion_alerts(ev(spark, sf_dir)))


@query
def congestion_alerts_out_of_order(spark, sf_dir):
    return flat_congestion(rules.congestion_alerts(late(spark, sf_dir), order=LATE))


@query
def accident_alerts(spark, sf_dir):
    return flat_accident(rules.accident_alerts(ev(spark, sf_dir)))


@query
def accident_alerts_out_of_order(spark, sf_dir):
    return flat_accident(rules.accident_alerts(late(spark, sf_dir), order=LATE))


# -- normalisation ---------------------------------------------------------------


def alert_rows(spark, sf_dir) -> DataFrame:
    """Both rules, sent through the message format into the alert table."""
    records = ev(spark, sf_dir)
    layout = SeriesLayout.measure(records)
    feeds = {
        "congestion": rules.congestion_alerts(records, layout=layout),
        "accident": rules.accident_alerts(records, layout=layout),
    }
    return aggregates.union_alerts(
        *[
            normalize.normalize_alerts(topics.as_messages(alerts.drop("seq")), name)
            for name, alerts in feeds.items()
        ]
    )


@query
def alert_normalize(spark, sf_dir):
    message = oracles.RAW_ALERT.replace("{iso}", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")")
    raw = adapters.read_events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.expr(message).alias("value"))
    feeds = [normalize.normalize_alerts(raw, c, keep=["seq"]) for c in ("congestion", "accident")]
    return numbers(aggregates.union_alerts(*feeds), "accident_count").drop("raw_message")


@query
def recent_alerts(spark, sf_dir):
    return numbers(serving.recent_alerts(alert_rows(spark, sf_dir)), "accident_count")


@query
def alert_counters(spark, sf_dir):
    return serving.alert_counters(alert_rows(spark, sf_dir))


@query
def typed_events(spark, sf_dir):
    records = ev(spark, sf_dir)
    fields = [c for c in TOPIC_SCHEMA.names if c in records.columns]
    messages = topics.as_messages(records.select(*fields))
    return normalize.typed_events(messages).select(
        "event_time", "timestamp", *ROUTE_KEYS, "avg_speed", "vehicle_count", "avg_delay_minutes",
        "accident_count", "weather_condition", *CALENDAR, "latitude",
    )


# -- long-term features ------------------------------------------------------------


def daily(spark, sf_dir) -> DataFrame:
    return features.daily_rollup(ev(spark, sf_dir))


@query
def source_cutoff(spark, sf_dir):
    return features.source_cutoff(ev(spark, sf_dir))


@query
def baseline_7d(spark, sf_dir):
    return features.baseline(daily(spark, sf_dir)).select(*ROUTE_KEYS, *r4("baseline_speed_7d"))


@query
def hour_dow_28d(spark, sf_dir):
    return features.slot_means(daily(spark, sf_dir)).select(
        *features.SLOT_KEYS, *r4("avg_speed_hour_dow_4w", "avg_delay_hour_dow_4w")
    )


@query
def latest_slot_dates(spark, sf_dir):
    return features.latest_slot_dates(daily(spark, sf_dir)).select(*features.SLOT_KEYS, *text("latest_date"))


@query
def prev_day_same_hour(spark, sf_dir):
    return features.prev_day_same_hour(daily(spark, sf_dir)).select(
        *features.SLOT_KEYS, *text("latest_date"), *r4("avg_delay_same_hour_yesterday", "avg_speed_same_hour_yesterday")
    )


@query
def dense_slots(spark, sf_dir):
    return features.dense_slots(ev(spark, sf_dir).select(*ROUTE_KEYS).distinct())


def rounded_features(df: DataFrame) -> DataFrame:
    return df.select(*features.SLOT_KEYS, *r4(*LONGTERM_FEATURES), "source_cutoff", *text("dt"))


@query
def longterm_features(spark, sf_dir):
    return rounded_features(features.longterm_features(ev(spark, sf_dir)))


def feature_history(spark, sf_dir, online: bool = False) -> DataFrame:
    """The feature table after runs at several cutoffs."""
    return features.longterm_features(ev(spark, sf_dir), list(oracles.CUTOFFS), online=online)


@query
def longterm_features_daily(spark, sf_dir):
    return rounded_features(feature_history(spark, sf_dir))


@query
def online_snapshot(spark, sf_dir):
    # A long time to live, so that values carry over the days between cutoffs.
    history = feature_history(spark, sf_dir, online=True)
    state = features.online_snapshot(history, ttl_seconds=30 * 86400, as_of=oracles.CUTOFFS[-1])
    return state.select("feature_key", *r4(*LONGTERM_FEATURES), "source_cutoff")


@query
def online_publish(spark, sf_dir):
    """The records that go to the online store, field by field."""
    state = features.online_snapshot(feature_history(spark, sf_dir, online=True), ttl_seconds=30 * 86400, as_of=oracles.CUTOFFS[-1])
    sent = online.online_records(state, F.lit(oracles.CUTOFFS[-1]).cast("timestamp_ntz"))
    values = [near(F.col("fields")[c]).alias(c) for c in LONGTERM_FEATURES]
    return sent.select(
        "feature_key", F.size("fields").cast("long").alias("n_fields"), *values,
        F.col("fields")["updated_at"].cast("timestamp_ntz").alias("updated_at"),
    )


@query
def history_without_derived(spark, sf_dir):
    """Enriched records without the columns that enrichment adds."""
    enriched = enrich.enrich_series(ev(spark, sf_dir))
    return projections.drop_derived(enriched).select("seq", *ROUTE_KEYS, "avg_speed", "vehicle_count")


# -- training ----------------------------------------------------------------------


@query
def asof_training_set(spark, sf_dir):
    records = ev(spark, sf_dir)
    events = enrich.enrich_series(records)
    layout = training.training_layout(records)
    rows = training.training_set(events, feature_history(spark, sf_dir), "run 1", layout)
    means = {*ROLLING_COLUMNS, *LONGTERM_FEATURES}
    return rows.select(
        "training_run_id", *text("dt"), "event_ts", *ROUTE_KEYS,
        *[near(F.col(c)).alias(c) if c in means else F.col(c) for c in MODEL_FEATURES],
        "feature_source_cutoff",
    )


@query
def joinable_count(spark, sf_dir):
    return asof.joinable_count(ev(spark, sf_dir), feature_history(spark, sf_dir))


@query
def training_readiness(spark, sf_dir):
    """The gate before training: every count against the minimum."""
    events, history = ev(spark, sf_dir), feature_history(spark, sf_dir)
    needed = max(clusters.MIN_TRAINING_ROWS, clusters.CLUSTERS)
    return aggregates.readiness(events, history, asof.joinable_count(events, history), needed)


@query
def row_audit(spark, sf_dir):
    return aggregates.audit(ev(spark, sf_dir), ["event_ts", "avg_speed"])


# -- clusters ----------------------------------------------------------------------


def fixed_model() -> clusters.StateModel:
    """A model with stated parameters, so that its answers can be checked in SQL."""
    scaling = clusters.Scaling(tuple(oracles.MODEL_SQL_FEATURES), oracles.FILL, oracles.MEAN, oracles.SCALE)
    profiles = {
        k: {"status": s, "avg_speed": v, "avg_delay_minutes": d, "vehicle_count": 250.0, "samples": 1}
        for k, (s, v, d) in oracles.PROFILES.items()
    }
    pipeline = clusters.state_pipeline(scaling, oracles.CENTROIDS)
    return clusters.StateModel(pipeline, oracles.TRANSITIONS, profiles)


def wide_model() -> clusters.StateModel:
    """A model over all features with stated parameters."""
    scaling = clusters.Scaling(tuple(MODEL_FEATURES), oracles.WIDE_FILL, oracles.WIDE_MEAN, oracles.WIDE_SCALE)
    return replace(fixed_model(), pipeline=clusters.state_pipeline(scaling, oracles.WIDE_CENTROIDS))


def labelled(spark, sf_dir) -> DataFrame:
    return ev(spark, sf_dir).withColumn("cluster", F.expr(oracles.LABEL))


@query
def impute_scale(spark, sf_dir):
    rows = enrich.with_lags(ev(spark, sf_dir))
    scaling = clusters.learn_scaling(rows, oracles.SCALED)
    z = clusters.scaled(rows, scaling)
    return rows.select("seq", *[near(c).alias(name) for name, c in z.items()])


@query
def nearest_cluster(spark, sf_dir):
    states = fixed_model().pipeline.transform(ev(spark, sf_dir))
    return states.select("seq", *ROUTE_KEYS, *as_int("current_cluster"))


@query
def cluster_profiles(spark, sf_dir):
    return clusters.cluster_profiles(labelled(spark, sf_dir)).select(
        *as_int("cluster"), *r4("avg_speed", "avg_delay_minutes", "vehicle_count"), "samples", "status"
    )


@query
def transition_map(spark, sf_dir):
    day = F.date_trunc("DAY", "event_ts").cast("timestamp_ntz")
    states = labelled(spark, sf_dir).withColumn("event_ts", day)
    return clusters.transition_map(clusters.transition_counts(states, horizon="1 day"), 4)


@query
def kmeans_states(spark, sf_dir):
    """Fit on records laid on a 15-minute timeline; profile per fitted cluster."""
    records = projections.restamp(ev(spark, sf_dir).drop(*CALENDAR))
    events = enrich.enrich_series(records)
    stored = work_dir(spark, "training")
    training.training_set(events, features.longterm_features(records), "kmeans").write.parquet(stored)
    rows = spark.read.parquet(stored)
    _, states = clusters.fit_states(rows, stored=True)
    return clusters.cluster_profiles(states).select("status", "samples", *r4("avg_speed", "avg_delay_minutes"))


PLANTED = ["avg_speed", "avg_delay_minutes", "vehicle_count"]


def planted_states(spark, sf_dir) -> DataFrame:
    """Six routes on a 15-minute timeline, in one of three states far apart."""
    rows = adapters.read_events(spark, sf_dir).select(F.expr("event_id % 6").alias("route"), F.expr("event_id div 6").alias("step"))
    state = F.expr("CAST((step div 2 + route) % 3 AS INT)")
    return rows.select(
        F.concat(F.lit("r"), F.col("route")).alias("road_name"), F.lit("d").alias("district"), F.lit("c").alias("city"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(step * 15 AS INT))").alias("event_ts"),
        (F.lit(90.0) - 40.0 * state + (F.col("step") % 5) / 10.0).alias("avg_speed"),
        (8.0 * state + (F.col("step") % 3) / 10.0).alias("avg_delay_minutes"),
        (F.lit(100) + 200 * state + F.col("step") % 7).alias("vehicle_count"),
    )


@query
def kmeans_planted(spark, sf_dir):
    """Fitted clusters by status: size, profile and the state half an hour later."""
    model, _ = clusters.fit_states(planted_states(spark, sf_dir), PLANTED)
    status = {k: p["status"] for k, p in model.profiles.items()}
    rows = [
        (status[k], p["samples"], p["avg_speed"], p["avg_delay_minutes"], p["vehicle_count"], status[model.transitions[k]])
        for k, p in model.profiles.items()
    ]
    found = spark.createDataFrame(
        rows, "status string, samples long, avg_speed double, avg_delay_minutes double, vehicle_count double, next_status string"
    )
    return found.select("status", "samples", *r4("avg_speed", "avg_delay_minutes", "vehicle_count"), "next_status")


@query
def kmeans_metrics(spark, sf_dir):
    """The metrics of a fit as a row."""
    model, _ = clusters.fit_states(planted_states(spark, sf_dir), PLANTED)
    row = spark.createDataFrame([tuple(map(float, model.metrics.values()))], ", ".join(f"{m} double" for m in model.metrics))
    return row.select(
        F.round("inertia", 3).alias("inertia"), F.col("transition_rows").cast("long").alias("transition_rows"),
        *r4("silhouette_score", "silhouette_error"),
    )


@query
def topic_view(spark, sf_dir):
    """The typed view over a topic, of which some messages are no records."""
    records = sourced(ev(spark, sf_dir))
    fields = [c for c in TOPIC_SCHEMA.names if c in records.columns]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    broken = F.when(F.col("seq") % 13 == 0, F.substring(body, F.lit(1), F.length(body) - 1))
    wrong = F.when(F.col("seq") % 13 == 1, F.lit('{"vehicle_count":"many"}'))
    messages = records.select(
        F.coalesce(broken, wrong, body).cast("binary").alias("value"), "topic", "partition", "offset",
        F.col("event_ts").cast("timestamp").alias("timestamp"),
    )
    view = topics.read_topic(spark, TOPIC_ENRICHED, TOPIC_SCHEMA, source=messages, streaming=False)
    return view.select(
        "topic", F.col("partition").cast("int").alias("partition"), "offset", "timestamp", *ROUTE_KEYS, "avg_speed",
        "vehicle_count", "latitude", "weather_condition", *CALENDAR, F.size("present").alias("n_present"),
    )


# -- scoring -----------------------------------------------------------------------


def predictions(spark, sf_dir, *extra: str, model: clusters.StateModel | None = None) -> DataFrame:
    return scoring.score(ev(spark, sf_dir), None, model or fixed_model(), *extra)


def prediction_table(spark, sf_dir) -> DataFrame:
    return normalize.normalize_predictions(topics.as_messages(predictions(spark, sf_dir)))


def newest_prediction_table(spark, sf_dir) -> DataFrame:
    """The last prediction of every route, reduced before its message is written and parsed."""
    values = [
        "forecast_horizon_minutes", "current_cluster", "predicted_cluster", "traffic_status", "expected_avg_speed",
        "expected_avg_delay_minutes", "model_status",
    ]
    ties = [F.col(f"prediction_30m.{c}").asc_nulls_last() for c in values]
    order = [F.col("timestamp").desc_nulls_last(), *ties]
    newest = enrich.latest_row(predictions(spark, sf_dir), ROUTE_KEYS, order)
    return normalize.normalize_predictions(topics.as_messages(newest))


def flat(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*extra, *ROUTE_KEYS, "timestamp", "prediction_30m.*")


@query
def predict_next_state(spark, sf_dir):
    return flat(predictions(spark, sf_dir, "seq"), "seq")


@query
def model_by_alias(spark, sf_dir):
    """The same predictions by a model that was published and loaded again.

    Two versions have one publication time; the one published last is current.
    """
    root, at = work_dir(spark, "models"), datetime(2024, 1, 1)
    model = fixed_model()
    models.publish_model(spark, replace(model, transitions=dict.fromkeys(model.transitions, 0)), root, "run-2", published_at=at)
    models.publish_model(spark, model, root, "run-1", expected=1, published_at=at)
    return flat(predictions(spark, sf_dir, "seq", model=models.load_model(spark, root)), "seq")


def latest_snapshot(spark, sf_dir) -> DataFrame:
    """The online snapshot after a run at the newest event."""
    records = ev(spark, sf_dir)
    cutoff = features.source_cutoff(records).first()["source_cutoff"]
    return features.online_snapshot(features.longterm_features(records, cutoff, online=True), as_of=cutoff)


@query
def score_enriched(spark, sf_dir):
    """The path of every record: filled, enriched, features looked up, all of them scored."""
    records = ev(spark, sf_dir)
    filled = enrich.latest_fill(
        adapters.sensor_part(records), adapters.weather_part(records), present="present"
    )
    enriched = enrich.enrich_series(filled, layout=SeriesLayout.measure(records))
    routes = records.select(*ROUTE_KEYS).distinct()
    scored = scoring.score(enriched, latest_snapshot(spark, sf_dir), wide_model(), "seq", routes=routes)
    return flat(scored, "seq")


@query
def online_lookup(spark, sf_dir):
    records = ev(spark, sf_dir)
    routes = records.select(*ROUTE_KEYS).distinct()
    looked_up = scoring.with_online_features(records, latest_snapshot(spark, sf_dir), routes)
    return looked_up.select("seq", *r4(*LONGTERM_FEATURES))


@query
def prediction_normalize(spark, sf_dir):
    return prediction_table(spark, sf_dir).drop("raw_message")


@query
def flatten_predictions(spark, sf_dir):
    return normalize.flatten_predictions(predictions(spark, sf_dir))


@query
def latest_predictions(spark, sf_dir):
    return serving.latest_predictions(newest_prediction_table(spark, sf_dir))


@query
def board_with_predictions(spark, sf_dir):
    newest = serving.newest_predictions(newest_prediction_table(spark, sf_dir))
    return serving.board_with_predictions(serving.road_states(ev(spark, sf_dir)), newest)


@query
def predicted_status_distribution(spark, sf_dir):
    return serving.predicted_status_distribution(newest_prediction_table(spark, sf_dir))


@query
def prediction_counters(spark, sf_dir):
    return serving.prediction_counters(newest_prediction_table(spark, sf_dir))


# -- tables ------------------------------------------------------------------------


@query
def offset_range_scan(spark, sf_dir):
    rows = sourced(ev(spark, sf_dir))
    ends = {r["partition"]: r["end"] for r in rows.groupBy("partition").agg((F.max("offset") + 1).alias("end")).collect()}
    scan = topics.offset_range_scan(rows, {0: 100, 1: 50}, ends)
    return scan.select("seq", "partition", "offset", "avg_speed")


def lake_rows(rows: DataFrame) -> DataFrame:
    """Topic rows in the layout of the enriched lake table."""
    typed = projections.with_lineage(projections.with_event_time(rows))
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in ENRICHED_SCHEMA.fields if f.name not in typed.columns
    }
    return typed.withColumns(missing).select(*ENRICHED_SCHEMA.names)


def lake_view(spark: SparkSession, target: str) -> DataFrame:
    return tables.read_or_none(spark, target, ENRICHED_SCHEMA).select(
        "source_topic", "source_partition", "source_offset", *text("dt"), *ROUTE_KEYS, "avg_speed"
    )


@query
def merge_insert_only(spark, sf_dir):
    """Overlapping batches, the last one repeated: every record arrives once."""
    rows, target = lake_rows(sourced(ev(spark, sf_dir))), work_dir(spark, "enriched")
    tables.insert_only(rows.where("source_partition < 2"), target)
    tables.insert_only(rows, target)
    tables.insert_only(rows, target)
    return lake_view(spark, target)


@query
def ingest_topic(spark, sf_dir):
    """Incremental load of a stream, run twice from the same bookmark."""
    stream = lake_rows(sourced(adapters.sensor_stream(spark, sf_dir)))
    target, checkpoint = work_dir(spark, "enriched"), work_dir(spark, "bookmark")
    for _ in range(2):
        tables.ingest_insert_only(stream, target, checkpoint)
    return lake_view(spark, target)


@query
def replace_by_key(spark, sf_dir):
    """All cutoffs written, then one of them again."""
    target = work_dir(spark, "longterm")
    history = feature_history(spark, sf_dir)
    tables.replace_by_key(history, target, "source_cutoff")
    again = F.lit(oracles.CUTOFFS[-1]).cast("timestamp_ntz")
    tables.replace_by_key(history.where(F.col("source_cutoff") == again), target, "source_cutoff")
    stored = spark.read.parquet(target)
    return rounded_features(stored.withColumn("source_cutoff", F.col("source_cutoff").cast("timestamp_ntz")))


def lake(spark: SparkSession) -> dict[str, tables.LakeTable]:
    """The lake tables in a database of their own."""
    root = work_dir(spark, "lake")
    database = root.rsplit("/", 1)[-1].replace("-", "_")
    tables.ensure_tables(spark, root, database)
    return {name: tables.lake_table(spark, name, database) for name in tables.TABLES}


@query
def lake_tables(spark, sf_dir):
    """Inserts and replacements by name, each seen by the next reader of the name."""
    target = lake(spark)
    rows = lake_rows(sourced(ev(spark, sf_dir)))
    tables.insert_only(rows.where("source_partition < 2"), target["enriched_events"])
    tables.insert_only(rows, target["enriched_events"])
    history = feature_history(spark, sf_dir)
    features_table = target["longterm_features"]
    features_table.append(history.withColumn("baseline_speed_7d", F.lit(-1.0)))
    features_table.replace(history, "source_cutoff")
    features_table.replace(history.where(F.col("source_cutoff") == oracles.CUTOFFS[-1]), "source_cutoff")
    records = ev(spark, sf_dir)
    layout = training.training_layout(records)
    run = training.training_set(enrich.enrich_series(records), features_table.rows(), "run 1", layout)
    target["training_kmeans_30m"].replace(run, "training_run_id")

    def shown(name: str, number: Column, value: str) -> DataFrame:
        found = target[name].rows()
        return found.select(
            F.lit(name).alias("table_name"), *text("dt"), *ROUTE_KEYS, number.cast("long").alias("number"),
            near(F.col(value)).alias("value"),
        )

    slot = F.col("hour") * 7 + F.col("day_of_week")
    return (
        shown("enriched_events", F.col("source_offset"), "avg_speed")
        .unionByName(shown("longterm_features", slot, "baseline_speed_7d"))
        .unionByName(shown("training_kmeans_30m", slot, "baseline_speed_7d"))
    )


class MergeFailed(RuntimeError):
    """Raised on purpose between a merge and its entry in the ledger."""


@query
def ingest_ledger(spark, sf_dir):
    """Three ingest runs by offset; the second fails after its merge and is repeated."""
    messages = sourced(ev(spark, sf_dir))
    target = lake(spark)["enriched_events"]
    book = ledger.OffsetLedger(spark, work_dir(spark, "ledger"))

    def merge(rows: DataFrame) -> None:
        tables.insert_only(lake_rows(rows), target)

    def failing(rows: DataFrame) -> None:
        merge(rows)
        raise MergeFailed

    ledger.ingest_offsets(messages.where("offset < 100"), book, merge)
    for attempt in (failing, merge):
        with suppress(MergeFailed):
            ledger.ingest_offsets(messages.where("offset < 200 OR partition = 2"), book, attempt)
    ledger.ingest_offsets(messages, book, merge)
    held = target.rows().groupBy(F.col("source_partition").alias("partition")).agg(F.count(F.lit(1)).alias("merged_rows"))
    return book.runs().join(held, "partition")


@query
def drain_predictions(spark, sf_dir):
    stream = scoring.score(adapters.sensor_stream(spark, sf_dir), None, fixed_model())
    target = work_dir(spark, "predictions")
    tables.drain_to_parquet(stream, target, "run:1", date(2024, 1, 1), work_dir(spark, "bookmark"))
    return spark.read.parquet(f"{target}/dt=2024-01-01/run=run-1").drop("batch")


# -- streams -----------------------------------------------------------------------

#: Micro-batches that a stream query has at least; rows of one micro-batch, and of one of
#: its files, which a task reads.
LEAST_BATCHES, ROWS_PER_BATCH, ROWS_PER_FILE = 4, 2_000_000, 125_000


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a stream that arrives in consecutive files, as many per micro-batch as tasks read it."""
    events = adapters.read_events(spark, sf_dir)
    rows = events.count()
    batches = carried.files_for(rows, ROWS_PER_BATCH, LEAST_BATCHES)
    each = carried.files_for(-(-rows // batches), ROWS_PER_FILE)
    path = carried.arrival_copy(events, work_dir(spark, "arrivals"), ["event_id"], batches * each)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", each).parquet(path)
    return adapters.as_traffic(stream)


def finished(spark: SparkSession, stream: DataFrame, steps: list, name: str, **more) -> DataFrame:
    """Run a carried job over everything available and read its table."""
    table = carried.BatchTable(spark, work_dir(spark, name), work_dir(spark, f"{name}-manifest"))
    carried.CarriedJob(steps, table, work_dir(spark, f"{name}-job"), **more).start(stream).awaitTermination()
    return spark.read.parquet(table.path).drop("batch")


def both_sides(records: DataFrame) -> DataFrame:
    """Sensor records and weather reports as one stream."""
    return carried.Fill.both(
        adapters.sensor_part(records), adapters.weather_part(records), AREA_KEYS, ["seq"], WEATHER
    )


@query
def stream_enrich(spark, sf_dir):
    steps = [carried.Fill(present="present"), carried.Windows()]
    rows = finished(spark, both_sides(arrivals(spark, sf_dir)), steps, "enriched")
    return numbers(rows, "accident_count").select(*ENRICHED_OUT, *r4(*ROLLING_COLUMNS))


@query
def stream_congestion(spark, sf_dir):
    return flat_congestion(finished(spark, arrivals(spark, sf_dir), [carried.Congestion()], "congestion"))


@query
def stream_accident(spark, sf_dir):
    return flat_accident(finished(spark, arrivals(spark, sf_dir), [carried.Accidents()], "accident"))


@query
def stream_alert_table(spark, sf_dir):
    records = arrivals(spark, sf_dir)
    feeds = {"congestion": carried.Congestion(), "accident": carried.Accidents()}

    def shaped(name: str):
        return lambda alerts: normalize.normalize_alerts(topics.as_messages(alerts.drop("seq")), name)

    parts = [finished(spark, records, [step], name, finish=shaped(name)) for name, step in feeds.items()]
    return numbers(aggregates.union_alerts(*parts), "accident_count").select(*serving.ALERT_COLUMNS)


class Stopped(RuntimeError):
    """Raised on purpose in the middle of a stream."""


@query
def pipeline_once(spark, sf_dir):
    """The chained topology, stopped half way and resumed from its checkpoints.

    The enriching query is stopped in its second micro-batch, after its rows are
    written. The consumers see what it has finished, then a new run does the rest. The
    snapshot and the model come from their stores, which get a new version in between.
    """
    root, store = work_dir(spark, "topology"), work_dir(spark, "models")
    snapshots = online.SnapshotTable(spark, work_dir(spark, "snapshots"))
    snapshots.publish(latest_snapshot(spark, sf_dir))
    models.publish_model(spark, wide_model(), store, "run-1")
    records = arrivals(spark, sf_dir)

    def topology() -> jobs.Pipeline:
        scorer = jobs.Scorer(
            snapshots.load, lambda: models.load_model(spark, store), snapshots.newest,
            lambda: models.current_alias(spark, store).number,
        )
        return jobs.Pipeline(
            spark, root, adapters.sensor_part(records), adapters.weather_part(records), present="present", scorer=scorer
        )

    first = topology()
    enriched = first.table("enriched_events")

    class Breaking(carried.BatchTable):
        def write(self, batch_id: int, rows: DataFrame) -> None:
            super().write(batch_id, rows)
            if batch_id == 1:
                raise Stopped

    with suppress(StreamingQueryException):
        first.start_enrich(once=True, table=Breaking(spark, enriched.path, enriched.manifest)).awaitTermination()
    for part in first.start_consumers(once=True):
        part.awaitTermination()
    snapshots.publish(snapshots.load())
    models.publish_model(spark, wide_model(), store, "run-2")
    last = topology()
    last.run_once()

    def shown(name: str, at: str, label: Column, value: str) -> DataFrame:
        rows = spark.read.parquet(last.path(name))
        return rows.select(
            F.lit(name).alias("table_name"), *ROUTE_KEYS, F.col(at).alias("at"), label.alias("label"),
            near(F.col(value)).alias("value"),
        )

    state = F.concat_ws(" ", F.col("current_cluster").cast("string"), "predicted_traffic_status")
    return (
        shown("enriched_events", "event_ts", F.col("weather_condition"), "rolling_avg_speed_3")
        .unionByName(shown("traffic_alerts", "alert_time", F.concat_ws(" ", "alert_category", "severity"), "avg_speed"))
        .unionByName(shown("traffic_predictions", "prediction_time", state, "expected_avg_delay_minutes"))
    )


@query
def stream_score(spark, sf_dir):
    """Scoring per micro-batch with a model read from its alias each time."""
    root, target = work_dir(spark, "models"), work_dir(spark, "predictions")
    models.publish_model(spark, fixed_model(), root, "run-1")

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = normalize.normalize_predictions(topics.as_messages(batch))
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    jobs.score_stream(
        adapters.sensor_stream(spark, sf_dir), sink, work_dir(spark, "checkpoint"),
        lambda: None, lambda: models.load_model(spark, root), once=True,
    ).awaitTermination()
    return spark.read.parquet(target).select(*serving.PREDICTION_COLUMNS)
