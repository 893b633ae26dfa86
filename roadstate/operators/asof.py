"""Point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadstate.operators.series import SeriesLayout, running_last, running_sum
from roadstate.schemas import ROUTE_KEYS

ASOF_KEYS = [*ROUTE_KEYS, "hour", "day_of_week"]
#: Order of a point-in-time match: features before events at one time. The last column
#: says nothing about the match; by it, a key whose events share one time can be cut.
ASOF_ORDER = ("_time", "_side", "_tie")


def tie_breaker(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A hash of the row, which sets rows of equal time apart (except copies)."""
    names = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in names if columns is None or c in columns])


def asof_left(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = tuple(ASOF_KEYS),
    left_ts: str = "event_ts",
    right_ts: str = "source_cutoff",
    payload: Sequence[str] = (),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Left join to the latest right row at or before each left row.

    A tagged union ordered by time, right rows first at equal times, and the
    running latest payload: linear in both inputs. An equality-plus-range join
    would multiply every event by all earlier cutoffs of its key. ``right`` must
    hold one row per key and time. The matched time comes back as
    ``feature_<right_ts>``; unmatched rows keep nulls.
    """
    matched = f"feature_{right_ts}"
    record = F.struct(F.col(right_ts).alias(matched), *payload)
    feature_rows = right.where(F.col(right_ts).isNotNull()).select(
        *keys,
        F.col(right_ts).alias("_time"),
        F.lit(0).alias("_side"),
        F.lit(0).cast("long").alias("_tie"),
        record.alias("_match"),
    )
    event_rows = left.withColumns({"_time": F.col(left_ts), "_side": F.lit(1), "_tie": tie_breaker(left)})
    both = event_rows.unionByName(feature_rows, allowMissingColumns=True)
    latest = running_last(both, "_match", keys, ASOF_ORDER, layout)
    return latest.where(F.col("_side") == 1).select(
        *left.columns,
        *[F.col(f"_match.{c}").alias(c) for c in payload],
        F.col(f"_match.{matched}").alias(matched),
    )


def joinable_count(
    events: DataFrame,
    features: DataFrame,
    keys: Sequence[str] = tuple(ASOF_KEYS),
    left_ts: str = "event_ts",
    right_ts: str = "source_cutoff",
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Number of (event, feature) pairs with the feature at or before the event.

    Counted, never produced: each event adds the running number of features of
    its key. Events at one time are counted before the shuffle. Features are not: they
    have one row per key and time, so a table of their counts would only fill the memory
    of the task that lays out the grid.
    """
    def keyed(df: DataFrame, ts: str) -> DataFrame:
        whole = ("hour", "day_of_week")
        return df.na.drop(subset=[ts, *keys]).select(
            *[F.col(k).cast("int").alias(k) if k in whole else F.col(k) for k in keys],
            F.col(ts).alias("_time"),
        )

    if layout is None:
        layout = SeriesLayout.measure(keyed(events, left_ts), keys, ("_time",))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    known = keyed(features, right_ts).withColumns({"_features": one, "_events": none, "_side": F.lit(0)})
    counts = keyed(events, left_ts).groupBy(*keys, "_time").agg(F.count(F.lit(1)).alias("_events"))
    both = known.unionByName(counts.withColumns({"_features": none, "_side": F.lit(1)}))
    seen = running_sum(both, "_features", keys, ("_time", "_side"), layout)
    pairs = F.sum(F.col("_events") * F.col("_features"))
    return seen.where(F.col("_side") == 1).agg(F.coalesce(pairs, F.lit(0)).alias("joinable_rows"))
