"""Message topics as DataFrames: value text plus source coordinates.

Every reader takes an optional ``source`` so that any DataFrame with the columns
``value, topic, partition, offset, timestamp`` can stand in for a broker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadstate.operators.normalize import parse_records
from roadstate.schemas import ROUTE_KEYS

COORDINATES = ["topic", "partition", "offset", "timestamp"]


def raw_topic(
    spark: SparkSession,
    topic: str,
    options: Mapping[str, str] | None = None,
    source: DataFrame | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages as text with their coordinates (broker time as ``broker_ts``)."""
    if source is None:
        reader = spark.readStream if streaming else spark.read
        start = "latest" if streaming else "earliest"
        reader = reader.format("kafka").option("subscribe", topic).option("startingOffsets", start)
        source = reader.options(**(options or {})).load()
    return source.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("broker_ts"),
    )


def read_topic(
    spark: SparkSession,
    topic: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
    source: DataFrame | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Typed view of a topic: fields of ``schema`` plus coordinates."""
    good, _ = parse_records(raw_topic(spark, topic, options, source, streaming), schema)
    return good


def rejected_rows(
    spark: SparkSession,
    topic: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
    source: DataFrame | None = None,
    streaming: bool = True,
) -> DataFrame:
    """The messages ``read_topic`` leaves out, as text."""
    _, bad = parse_records(raw_topic(spark, topic, options, source, streaming), schema)
    return bad


def as_messages(df: DataFrame, keys: Sequence[str] = tuple(ROUTE_KEYS)) -> DataFrame:
    """Rows as compact JSON values keyed by series, so a series stays ordered."""
    return df.select(
        F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("")) for k in keys]).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_topic(
    df: DataFrame,
    topic: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
) -> StreamingQuery:
    """Stream rows to a topic, at least once."""
    writer = as_messages(df, keys).writeStream.format("kafka").options(**(options or {}))
    return writer.option("topic", topic).option("checkpointLocation", checkpoint).start()


def offset_range_scan(
    df: DataFrame,
    start: Mapping[int, int],
    end: Mapping[int, int],
    partition: str = "partition",
    offset: str = "offset",
) -> DataFrame:
    """Rows with ``start <= offset < end`` per partition.

    A missing start counts as 0; partitions without new offsets are left out. A
    plain predicate, so it reaches the scan.
    """
    ranges = [
        (F.col(partition) == p) & (F.col(offset) >= start.get(p, 0)) & (F.col(offset) < last)
        for p, last in sorted(end.items())
        if last > start.get(p, 0)
    ]
    return df.where(reduce(or_, ranges)) if ranges else df.where(F.lit(False))
