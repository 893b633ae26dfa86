"""Partitioned Parquet tables with idempotent writes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadstate.operators.normalize import flatten_predictions
from roadstate.schemas import ENRICHED_SCHEMA, LONGTERM_SCHEMA, TRAINING_SCHEMA

# Table names of the lake.
TABLES = {
    "enriched_events": ENRICHED_SCHEMA,
    "longterm_features": LONGTERM_SCHEMA,
    "training_kmeans_30m": TRAINING_SCHEMA,
}
MERGE_KEYS = ("source_topic", "source_partition", "source_offset")


def ensure_tables(spark: SparkSession, root: str, database: str = "traffic") -> list[str]:
    """Create the three lake tables below ``root`` unless they exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    names = []
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
            f"USING parquet PARTITIONED BY (dt) LOCATION '{root}/{name}'"
        )
        names.append(f"{database}.{name}")
    return names


@contextmanager
def partition_swaps(spark: SparkSession) -> Iterator[None]:
    """Overwrites by table name replace the partitions they write and no others.

    ``insertInto`` takes the mode from the session only; under the default one it would
    drop all other partitions, and a plan that reads the table is refused.
    """
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass(frozen=True)
class LakeTable:
    """A partitioned table of the catalog, written and read by its name.

    Every write goes through the table, so the catalog learns a new partition in the
    command that writes it, and a reader by name sees the rows at once. A writer that
    only knows the folder (a file sink, another job) is followed by ``register``.
    """

    spark: SparkSession
    name: str

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def columns(self) -> list[str]:
        return self.rows().columns

    @property
    def partition_by(self) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]

    def append(self, rows: DataFrame) -> None:
        """Add rows; their columns are matched by name, a missing one is null."""
        self._aligned(rows).hint("rebalance", *self.partition_by).write.insertInto(self.name)

    def replace(self, rows: DataFrame, key_col: str) -> None:
        """Replace all rows of the keys in ``rows``, whatever partitions they are in.

        Partitions that hold such a key are rewritten with their other rows and the new
        ones, by a swap of partitions; one that is left without rows is dropped. An
        empty input replaces nothing.
        """
        rows = self._aligned(rows).persist()
        try:
            keys = rows.select(F.col(key_col).alias("_key")).distinct()
            theirs = F.col(key_col).eqNullSafe(F.col("_key"))
            old, days = self.rows(), self.partition_by
            # Partitions that hold one of the keys or get rows now; one row each.
            holding = old.join(keys, theirs, "left_semi").select(*days).distinct().collect()
            filled = rows.select(*days).distinct().collect()
            final, touched = rows, {tuple(r) for r in [*holding, *filled]}
            if touched:
                wanted = self.spark.createDataFrame(list(touched), old.select(*days).schema).toDF(*[f"_{d}" for d in days])
                same = [old[d].eqNullSafe(wanted[f"_{d}"]) for d in days]
                others = old.join(F.broadcast(wanted), same, "left_semi").join(keys, theirs, "left_anti")
                final = rows.unionByName(others)
            stay = {tuple(r) for r in final.select(*days).distinct().collect()}
            with partition_swaps(self.spark):
                final.hint("rebalance", *days).write.insertInto(self.name, overwrite=True)
            for day in holding:
                if tuple(day) not in stay:
                    self._drop(day.asDict())
        finally:
            rows.unpersist()

    def register(self) -> None:
        """Tell the catalog of partitions that were written to the folder only."""
        self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)

    def _aligned(self, rows: DataFrame) -> DataFrame:
        schema = self.rows().schema
        return rows.select(
            *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        )

    def _drop(self, partition: dict) -> None:
        spec = ", ".join(f"`{c}` = " + ("null" if v is None else f"'{v}'") for c, v in partition.items())
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")


def lake_table(spark: SparkSession, name: str, database: str = "traffic") -> LakeTable:
    return LakeTable(spark, f"{database}.{name}")


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when the path does not exist yet."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def insert_only(
    batch: DataFrame,
    target: str | LakeTable,
    key_cols: Sequence[str] = MERGE_KEYS,
    partition_by: str = "dt",
    range_col: str | None = "source_offset",
) -> int:
    """Append the rows whose key is not in the table yet; returns the rows of ``batch``.

    ``target`` is a table of the catalog or the path of a folder. A record always falls
    into the same partition, so only the partitions and offset range the batch touches
    are read back for the anti join.
    """
    spark = batch.sparkSession
    by_name = isinstance(target, LakeTable)
    batch = batch.persist()
    try:
        found = batch.count()
        existing = target.rows() if by_name else read_or_none(spark, target, batch.schema)
        fresh = batch
        if existing is not None:
            limits = [F.min(partition_by), F.max(partition_by), F.count_if(F.col(partition_by).isNull())]
            limits += [F.min(range_col), F.max(range_col)] if range_col else []
            first, last, undated, *span = batch.agg(*limits).first()
            within = F.col(partition_by).between(F.lit(first), F.lit(last))
            known = existing.where(within | F.col(partition_by).isNull() if undated else within)
            if range_col:
                known = known.where(F.col(range_col).between(*map(F.lit, span)))
            fresh = batch.join(known.select(*key_cols), list(key_cols), "left_anti").select(*batch.columns)
        if by_name:
            target.append(fresh)
            return found
        # One partition's rows meet in few tasks, and a large one is split.
        fresh.hint("rebalance", partition_by).write.partitionBy(partition_by).mode("append").parquet(target)
        return found
    finally:
        batch.unpersist()


def ingest_insert_only(
    source: DataFrame,
    target: str | LakeTable,
    checkpoint: str,
    key_cols: Sequence[str] = MERGE_KEYS,
    partition_by: str = "dt",
    range_col: str | None = "source_offset",
) -> int:
    """Load everything new in a stream, once; returns the rows read.

    The checkpoint is the bookmark: it moves only after a batch is written, and
    a batch that is replayed inserts nothing twice.
    """
    counts: dict[int, int] = {}  # by batch, so a replayed batch counts once

    def load(batch: DataFrame, batch_id: int) -> None:
        counts[batch_id] = insert_only(batch, target, key_cols, partition_by, range_col)

    query = (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(counts.values())


def replace_by_key(
    df: DataFrame, target: str, key_col: str, partition_by: Sequence[str] = ()
) -> None:
    """Replace the rows of the keys present in ``df``; a rerun changes nothing.

    The key is the leading partition column, so the replacement is a swap of
    partitions instead of a delete.
    """
    columns = [key_col, *partition_by]
    (
        df.hint("rebalance", *columns)
        .write.partitionBy(*columns)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(target)
    )


def append_stream(
    df: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = (), once: bool = False
) -> StreamingQuery:
    """Continuous ingest of a typed stream into a partitioned table."""
    writer = df.writeStream.format("parquet").option("path", target)
    writer = writer.option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    return (writer.trigger(availableNow=True) if once else writer).start()


def drain_to_parquet(
    predictions: DataFrame, path: str, run_id: str, logical_date: date, checkpoint: str
) -> int:
    """Write all new predictions to ``dt=.../run=...``; returns their number.

    How much a micro-batch takes is the rate option of the source
    (``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``). Nothing new writes nothing.
    Each batch has its own folder, so a replay overwrites.
    """
    run = run_id.replace(":", "-")
    folder = f"{path}/dt={logical_date:%Y-%m-%d}/run={run}"
    counts: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = flatten_predictions(batch).persist()
        try:
            counts[batch_id] = rows.count()
            if counts[batch_id]:
                rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        finally:
            rows.unpersist()

    (
        predictions.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return sum(counts.values())
