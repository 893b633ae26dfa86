"""Summaries, counters and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


class NotEnoughRows(ValueError):
    """A gate found fewer rows than a step needs."""


def summary(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Row count, exact number of road names, two means, latest time."""
    return df.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("road_name").alias("total_roads"),
        F.avg("avg_speed").alias("avg_speed"),
        F.avg("avg_delay_minutes").alias("avg_delay"),
        F.max(ts).alias("latest_event_time"),
    )


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with a count per named condition."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc(col))
    )


def audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count with minimum and maximum of the listed columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)],
    )


def require_rows(df: DataFrame, needed: int, what: str = "rows") -> int:
    """The number of rows; raises when it is below ``needed``."""
    found = df.count()
    if found < needed:
        raise NotEnoughRows(f"{found} {what}, {needed} needed")
    return found


def readiness(events: DataFrame, features: DataFrame, joinable: DataFrame, needed: int) -> DataFrame:
    """One row: both row counts, the one-row ``joinable_rows``, and whether all suffice."""
    counts = (
        events.agg(F.count(F.lit(1)).alias("enriched_rows"))
        .crossJoin(features.agg(F.count(F.lit(1)).alias("feature_rows")))
        .crossJoin(joinable.select("joinable_rows"))
    )
    fewest = F.least("enriched_rows", "feature_rows", "joinable_rows")
    return counts.withColumn("ready", fewest >= needed)


def require_ready(gate: DataFrame) -> None:
    """Raises when the row of ``readiness`` says that training has too little data."""
    row = gate.first()
    if not row["ready"]:
        raise NotEnoughRows(f"not ready to train: {row.asDict()}")


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_alerts(*feeds: DataFrame) -> DataFrame:
    """One table from several alert feeds."""
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed)
    return merged
