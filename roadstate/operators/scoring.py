"""Prediction of the state half an hour ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadstate.functions.scalars import online_key, online_route, online_slot
from roadstate.operators.clusters import HORIZON_MINUTES, StateModel
from roadstate.operators.series import same_keys
from roadstate.schemas import LONGTERM_FEATURES, PREDICTION_STRUCT, ROUTE_KEYS


def with_online_features(
    events: DataFrame, snapshot: DataFrame | None, routes: DataFrame | None = None
) -> DataFrame:
    """Look up the long-term features of each event's slot; a miss leaves nulls.

    The store is keyed by text, of which slugs are the dear part. ``routes`` names the
    distinct routes of the events, where they can be had without computing the events
    again (a stored table, a cached batch): then slugs are made once per route, and an
    event joins on its route and appends hour and weekday. Without it every event makes
    its key, which also works on streams. Spark broadcasts routes and snapshot only when
    their measured size is below the session's threshold.
    """
    bare = events.drop(*LONGTERM_FEATURES, "source_cutoff")
    if snapshot is None:
        empty = {f: F.lit(None).cast("double") for f in LONGTERM_FEATURES}
        return bare.withColumns(empty | {"source_cutoff": F.lit(None).cast("timestamp_ntz")})
    features = snapshot.select(
        "feature_key",
        *[F.col(f).try_cast("double").alias(f) for f in LONGTERM_FEATURES],
        "source_cutoff",
    )
    if routes is None:
        keyed = bare.withColumn("feature_key", online_key())
    else:
        slugs = routes.select(*ROUTE_KEYS, online_route().alias("_route"))
        keyed = same_keys(bare, slugs, ROUTE_KEYS, "left").withColumn("feature_key", online_slot("_route")).drop("_route")
    return keyed.join(features, "feature_key", "left").drop("feature_key")


def prediction_record(df: DataFrame, *extra: str) -> DataFrame:
    """Route, text time and the nested prediction."""
    prediction = F.struct(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION_STRUCT.fields]
    )
    return df.select(*extra, *ROUTE_KEYS, "timestamp", prediction.alias("prediction_30m"))


def score(
    events: DataFrame,
    snapshot: DataFrame | None,
    model: StateModel | None,
    *extra: str,
    routes: DataFrame | None = None,
) -> DataFrame:
    """Current cluster, likely next cluster and its profile for every event.

    Without a model every row is still answered, with status ``unavailable``.
    """
    horizon = F.lit(HORIZON_MINUTES).alias("forecast_horizon_minutes")
    if model is None:
        blank = events.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in PREDICTION_STRUCT.fields}
        ).withColumns({"model_status": F.lit("unavailable"), "forecast_horizon_minutes": horizon})
        return prediction_record(blank, *extra)
    rows = with_online_features(events, snapshot, routes)
    current = model.pipeline.transform(rows)
    lookup = F.broadcast(model.lookup(events.sparkSession))  # one row per cluster
    joined = current.join(lookup, "current_cluster", "left").withColumns(
        {
            "predicted_cluster": F.coalesce("predicted_cluster", "current_cluster"),
            "model_status": F.lit("loaded"),
            "forecast_horizon_minutes": horizon,
        }
    )
    return prediction_record(joined, *extra)
