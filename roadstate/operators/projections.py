"""Stateless projections and filters over events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadstate.functions.scalars import calendar, now_ntz, parse_time
from roadstate.operators.series import SeriesLayout, series_rank
from roadstate.schemas import (
    CALENDAR,
    CLASS_COUNTS,
    CLASS_RATIOS,
    FLOW,
    LAG_COLUMNS,
    POSITION,
    ROLLING_COLUMNS,
    ROUTE_KEYS,
    TARGETS,
    TOPIC_ENRICHED,
    WEATHER,
)

FACETS = {
    "traffic": ["timestamp", *ROUTE_KEYS, *POSITION, *FLOW, *CALENDAR],
    "vehicles": [*ROUTE_KEYS, *CLASS_COUNTS, *CLASS_RATIOS],
    "weather": [*ROUTE_KEYS, *WEATHER],
    "weather_district": ["district", "city", *WEATHER],
}


def facet(df: DataFrame, name: str, *extra: str) -> DataFrame:
    """Keep the columns of one record facet, in table order."""
    return df.select(*extra, *[c for c in FACETS[name] if c in df.columns and c not in extra])


def drop_derived(df: DataFrame) -> DataFrame:
    """Remove look-back, rolling and target columns from historical records."""
    return df.drop(*LAG_COLUMNS, *ROLLING_COLUMNS, *TARGETS)


def with_calendar(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    return df.withColumns(calendar(ts))


def with_event_time(df: DataFrame, text: str = "timestamp") -> DataFrame:
    """Add ``event_ts`` (null for bad text) and its date ``dt``."""
    parsed = df.withColumn("event_ts", parse_time(text))
    return parsed.withColumn("dt", F.to_date("event_ts"))


def with_lineage(
    df: DataFrame,
    topic: str = TOPIC_ENRICHED,
    partition: str = "partition",
    offset: str = "offset",
    at: Column | None = None,
) -> DataFrame:
    """Add ingest time and the source coordinates of each record."""
    return df.withColumns(
        {
            "ingested_at": now_ntz() if at is None else at,
            "source_topic": F.lit(topic),
            "source_partition": F.col(partition).cast("int"),
            "source_offset": F.col(offset).cast("long"),
        }
    )


def valid_events(df: DataFrame, ts: str = "event_ts", keys: Sequence[str] = tuple(ROUTE_KEYS)) -> DataFrame:
    """Rows with an event time and a complete route."""
    return df.na.drop(subset=[ts, *keys])


def slot_range(df: DataFrame, hour: str = "hour", dow: str = "day_of_week") -> DataFrame:
    return df.where(F.col(hour).between(0, 23) & F.col(dow).between(0, 6))


def trailing(df: DataFrame, ts: str, cutoff: Column, days: int) -> DataFrame:
    """Rows at or after ``cutoff`` minus ``days`` days.

    Where the table carries its partition date, the same bound on ``dt`` lets
    the scan skip whole partitions.
    """
    start = cutoff - F.make_dt_interval(F.lit(days))
    rows = df.where(F.col(ts) >= start)
    return rows.where(F.col("dt") >= F.to_date(start)) if "dt" in df.columns else rows


def cast_all(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Cast listed columns in one projection; the rest pass through."""
    return df.select(
        *[F.col(c).cast(mapping[c]).alias(c) if c in mapping else F.col(c) for c in df.columns]
    )


def restamp(
    df: DataFrame,
    base: str = "2024-01-01 00:00:00",
    step_minutes: int = 15,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Lay each series on a regular timeline: record k gets ``base + k * step``."""
    ranked = series_rank(df, keys, order, "_k", layout)
    minutes = (F.col("_k") - 1) * step_minutes
    ts = F.timestamp_add("MINUTE", minutes, F.lit(base).cast("timestamp_ntz"))
    stamped = ranked.withColumn("event_ts", ts).drop("_k")
    text = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss")
    return with_calendar(stamped.withColumn("timestamp", text))


def filter_board(df: DataFrame, districts: Sequence[str], statuses: Sequence[str]) -> DataFrame:
    return df.where(F.col("district").isin(*districts) & F.col("road_status").isin(*statuses))


def map_points(df: DataFrame) -> DataFrame:
    """Rows with a position, as ``lat``/``lon`` points."""
    return df.na.drop(subset=["latitude", "longitude"]).select(
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        "road_name",
        "district",
        "road_status",
    )


def options(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values of a column."""
    return df.select(col).na.drop().distinct().orderBy(col)
