"""Publishing the online snapshot to an external key-value store."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadstate.functions.scalars import now_ntz
from roadstate.operators.features import ONLINE_TTL_SECONDS
from roadstate.schemas import LONGTERM_FEATURES

# writer(batch, ttl): batch is a list of (key, {field: text}).
Writer = Callable[[list[tuple[str, dict[str, str]]], int], None]


def online_records(
    snapshot: DataFrame,
    updated_at: Column | None = None,
    fields: Sequence[str] = tuple(LONGTERM_FEATURES),
) -> DataFrame:
    """(feature_key, fields): the non-null values as text, with the time of publishing."""
    stamp = now_ntz() if updated_at is None else updated_at
    values = {c: F.col(c) for c in [*fields, "source_cutoff"]} | {"updated_at": stamp}
    pairs = [x for name, value in values.items() for x in (F.lit(name), value.cast("string"))]
    filled = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    return snapshot.select("feature_key", filled.alias("fields"))


def publish_online(
    snapshot: DataFrame,
    writer: Writer,
    batch: int = 1000,
    ttl_seconds: int = ONLINE_TTL_SECONDS,
    fields: Sequence[str] = tuple(LONGTERM_FEATURES),
    updated_at: Column | None = None,
) -> None:
    """Send every key to ``writer`` from the executors, ``batch`` keys at a time.

    Only non-null fields are sent. ``writer`` is called again for keys of a
    retried task, so it must set values rather than add to them.
    """

    def send(partition: Iterable) -> None:
        entries: Iterator = ((r["feature_key"], dict(r["fields"])) for r in partition)
        while chunk := list(islice(entries, batch)):
            writer(chunk, ttl_seconds)

    online_records(snapshot, updated_at, fields).foreachPartition(send)


@dataclass(frozen=True)
class SnapshotTable:
    """Versions of the online snapshot in a folder, for look-ups by join.

    A version is visible when it is complete, and a reader that has loaded one keeps it
    until it asks for the newest again.
    """

    spark: SparkSession
    path: str

    def newest(self) -> int | None:
        """Number of the newest complete version."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        marks = hadoop(f"{self.path}/version=*/_SUCCESS")
        store = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = store.globStatus(marks) or []
        return max((int(s.getPath().getParent().getName().split("=")[1]) for s in found), default=None)

    def publish(self, snapshot: DataFrame) -> int:
        """Write the next version; returns its number."""
        number = (self.newest() or 0) + 1
        snapshot.write.parquet(f"{self.path}/version={number}")
        return number

    def load(self, number: int | None = None) -> DataFrame | None:
        """A version, the newest by default; None when there is none."""
        number = self.newest() if number is None else number
        return None if number is None else self.spark.read.parquet(f"{self.path}/version={number}")
