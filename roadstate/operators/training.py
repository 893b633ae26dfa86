"""Training set: events joined point-in-time to the long-term features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadstate.functions.scalars import now_ntz
from roadstate.functions.slugs import safe_name
from roadstate.operators.asof import ASOF_KEYS, ASOF_ORDER, asof_left, tie_breaker
from roadstate.operators.enrich import latest_row
from roadstate.operators.projections import cast_all
from roadstate.operators.series import SeriesLayout
from roadstate.schemas import LONGTERM_FEATURES, MODEL_FEATURES, ROUTE_KEYS, TRAINING_SCHEMA

EVENT_FEATURES = [c for c in MODEL_FEATURES if c not in LONGTERM_FEATURES]


def _typed(df: DataFrame, columns: list[str]) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in TRAINING_SCHEMA.fields}
    return cast_all(df.select(*columns), {c: types[c] for c in columns if c in types})


def training_layout(events: DataFrame) -> SeriesLayout:
    """Layout for ``training_set``, measured on narrow rows: the raw events serve as well as
    the enriched ones, since cut points only steer the balance."""
    rows = events.where(F.col("event_ts").isNotNull())
    places = rows.select(
        *ASOF_KEYS, F.col("event_ts").alias("_time"), F.lit(1).alias("_side"), tie_breaker(rows).alias("_tie")
    )
    return SeriesLayout.measure(places, ASOF_KEYS, ASOF_ORDER)


def training_set(
    events: DataFrame,
    features: DataFrame,
    run_id: str | Column = "run",
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """One row per route and event time with the features known at that time.

    Distinct event rows at the same route and time collapse to the one with the
    newest features; the remaining ties go to the smallest row in column order.
    That also removes exact copies, so neither side needs a DISTINCT (and its
    shuffle) before the join.
    """
    rows = _typed(events.where(F.col("event_ts").isNotNull()), ["event_ts", *ROUTE_KEYS, *EVENT_FEATURES])
    known = _typed(features, [*ASOF_KEYS, *LONGTERM_FEATURES, "source_cutoff"])
    if layout is None:
        # Only the events can pile up on a key; the features have one row per
        # key and cutoff. Callers that have the raw events measure on those.
        layout = training_layout(rows)
    joined = asof_left(rows, known, payload=LONGTERM_FEATURES, layout=layout)
    newest = F.col("feature_source_cutoff").desc_nulls_last()
    single = latest_row(
        joined, [*ROUTE_KEYS, "event_ts"], [newest, *[F.col(c).asc_nulls_last() for c in EVENT_FEATURES]]
    )
    run = safe_name(F.lit(run_id)) if isinstance(run_id, str) else run_id
    return single.withColumns(
        {"training_run_id": run, "dt": F.to_date("event_ts"), "created_at": now_ntz()}
    ).select(*TRAINING_SCHEMA.names)
