"""Ingest by offsets, with the offsets of what has been merged kept as data.

The ledger is a folder of one small file per run: a line per partition with the offsets
the run started and ended at. The newest run tells where the next one starts. It is
written only after the merge, so a run that fails in between is repeated from the same
offsets, and the merge, which inserts a record once, makes the repetition harmless.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstate.sources.topics import offset_range_scan

RUNS = "partition int, start_offset long, end_offset long, run int"


@dataclass(frozen=True)
class OffsetLedger:
    """Runs of one ingest job below ``path``."""

    spark: SparkSession
    path: str

    def _newest(self) -> tuple[int, dict[int, int] | None]:
        """Number of the newest run and its end offsets, None when they cannot be read."""
        try:
            files = self.spark.read.text(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return 0, {}
        if "run" not in files.columns:
            return 0, {}
        last = files.agg(F.max("run")).first()[0]
        if last is None:
            return 0, {}
        try:
            # One line per partition of the topic.
            lines = [json.loads(r.value) for r in files.where(F.col("run") == last).collect()]
            return last, {int(x["partition"]): int(x["end_offset"]) for x in lines}
        except (ValueError, KeyError, TypeError):
            return last, None

    def stored(self, defaults: Mapping[int, int]) -> dict[int, int]:
        """Where each partition goes on; partitions not stored, or all when the newest
        run cannot be read, start at their default."""
        _, ends = self._newest()
        return dict(defaults) | (ends or {})

    def commit(self, starts: Mapping[int, int], ends: Mapping[int, int]) -> int:
        """Record a finished run; returns its number."""
        last, _ = self._newest()
        lines = [
            (json.dumps({"partition": p, "start_offset": starts.get(p, 0), "end_offset": end}, sort_keys=True),)
            for p, end in sorted(ends.items())
        ]
        rows = self.spark.createDataFrame(lines, "value string").coalesce(1)
        rows.write.text(f"{self.path}/run={last + 1}")
        return last + 1

    def runs(self) -> DataFrame:
        """run, partition, start_offset, end_offset, n_records of every finished run."""
        # A line that is no record of a run comes out without its numbers.
        found = self.spark.read.schema(RUNS).json(self.path)
        return found.select("run", "partition", "start_offset", "end_offset").withColumn(
            "n_records", F.col("end_offset") - F.col("start_offset")
        )


def offset_bounds(messages: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """First offset and the one after the last, per partition of a topic."""
    # One row per partition of the topic.
    found = messages.groupBy("partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).collect()
    return {r["partition"]: r["first"] for r in found}, {r["partition"]: r["last"] + 1 for r in found}


def ingest_offsets(
    messages: DataFrame, ledger: OffsetLedger, merge: Callable[[DataFrame], object]
) -> int:
    """Merge every message that is not below the stored offsets; returns how many there are.

    ``messages`` is the topic as it is now (columns ``partition`` and ``offset``), ``merge``
    takes the new ones and must insert a record once however often it comes. The ledger
    moves after the merge. Without partitions, or without new offsets, nothing happens.
    """
    first, ends = offset_bounds(messages)
    starts = ledger.stored(first)
    if not any(end > starts.get(p, 0) for p, end in ends.items()):
        return 0
    merge(offset_range_scan(messages, starts, ends))
    # Offsets never go back: a topic that was cut off keeps what has been merged.
    done = {p: max(end, starts.get(p, 0)) for p, end in ends.items()}
    ledger.commit(starts, done)
    return sum(done[p] - starts.get(p, 0) for p in done)
