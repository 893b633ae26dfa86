"""Stateful operators as micro-batches over carried state tables.

A micro-batch is an ordinary DataFrame, so the batch operators of the package do the
work: a key of any size is cut by ``SeriesLayout``, and no key has to fit into a task.
What a key needs from earlier micro-batches is a few rows or one summary row, kept in a
state table with one version per micro-batch. Batch ``b`` reads version ``b - 1`` and
writes version ``b``, so a batch that is run again finds what it found the first time.

Tables that a stream writes have one folder per micro-batch and a manifest, to which a
batch is added when its folder is complete. A consumer streams the manifest: it sees
whole batches, in order, and never a batch in the middle of being written.

Arrival is the micro-batch first and the order columns inside it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadstate.operators.enrich import enrich_series, latest_fill
from roadstate.operators.rules import accident_alerts, congestion_from_runs, open_runs, speed_runs
from roadstate.operators.series import MAX_ROWS, SeriesLayout
from roadstate.schemas import AREA_KEYS, LAGS, ROLLING, ROUTE_KEYS, WEATHER

#: 0 for a carried row, 1 for one of the micro-batch; the first order column.
ROUND = "_round"
SIDE = "_stream_side"


def file_system(spark: SparkSession, path: str):
    """The store of ``path`` and its path object there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def complete(spark: SparkSession, folder: str) -> bool:
    """True when a job has written ``folder`` to its end."""
    store, mark = file_system(spark, f"{folder}/_SUCCESS")
    return store.exists(mark)


# -- tables ------------------------------------------------------------------------


@dataclass(frozen=True)
class StateTable:
    """State of one operator, one complete version per micro-batch."""

    spark: SparkSession
    path: str

    def _version(self, batch_id: int) -> str:
        return f"{self.path}/version={batch_id}"

    def before(self, batch_id: int) -> DataFrame | None:
        """What the micro-batch before left, None for the first one.

        A version that is missing is an error: the stream would start over unnoticed.
        """
        if batch_id == 0:
            return None
        if not complete(self.spark, self._version(batch_id - 1)):
            raise RuntimeError(f"no state of micro-batch {batch_id - 1} in {self.path}")
        return self.spark.read.parquet(self._version(batch_id - 1))

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Write the version of a batch and remove the one no replay can ask for."""
        rows.write.mode("overwrite").parquet(self._version(batch_id))
        if batch_id >= 2:
            store, old = file_system(self.spark, self._version(batch_id - 2))
            store.delete(old, True)


@dataclass(frozen=True)
class BatchTable:
    """A table written batch by batch, with a manifest of the complete batches."""

    spark: SparkSession
    path: str
    manifest: str

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def holds(self, batch_id: int) -> bool:
        return complete(self.spark, f"{self.manifest}/batch={batch_id}")

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Add a batch; one that is there already stays as consumers have seen it."""
        if self.holds(batch_id):
            return
        rows.write.mode("overwrite").parquet(self._folder(batch_id))
        line = self.spark.createDataFrame([(str(batch_id),)], "value string").coalesce(1)
        line.write.mode("overwrite").text(f"{self.manifest}/batch={batch_id}")

    def rows(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)

    def stream(self, batches_per_trigger: int = 1) -> DataFrame:
        """The manifest as a stream of batch numbers."""
        store, folder = file_system(self.spark, self.manifest)
        store.mkdirs(folder)  # a stream wants its folder to exist
        reader = self.spark.readStream.schema("value string").option("recursiveFileLookup", "true")
        reader = reader.option("maxFilesPerTrigger", batches_per_trigger).option("pathGlobFilter", "part-*")
        return reader.text(self.manifest)

    def load(self, numbers: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows of the batches that a micro-batch of ``stream`` names."""
        # As many lines as batches per trigger.
        found = sorted(int(r.value) for r in numbers.collect() if r.value)
        folders = [self._folder(b) for b in found]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders).select(*schema.names)


def arrival_copy(df: DataFrame, path: str, order: Sequence[str], files: int) -> str:
    """Copy rows into ``files`` consecutive ranges of ``order``, as a file stream reads them.

    One file per range, older by name and by modification time, so that
    ``maxFilesPerTrigger`` cuts the stream into micro-batches of bounded size that come
    in arrival order. A micro-batch of several files is read by as many tasks. All files are written at once; only their times are set one by one, a
    millisecond apart.
    """
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)
    store, folder = file_system(df.sparkSession, path)
    names = sorted(
        str(s.getPath()) for s in store.listStatus(folder) if s.getPath().getName().startswith("part-")
    )
    newest = max(store.getFileStatus(file_system(df.sparkSession, n)[1]).getModificationTime() for n in names)
    for i, name in enumerate(names):
        store.setTimes(file_system(df.sparkSession, name)[1], newest - (len(names) - i), -1)
    return path


def files_for(rows: int, rows_per_file: int = 2_000_000, least: int = 1) -> int:
    return max(least, ceil(rows / rows_per_file))


# -- steps -------------------------------------------------------------------------


@dataclass
class Done:
    """What a step makes of a micro-batch: rows, the state after it, tables it has cached."""

    rows: DataFrame
    state: DataFrame
    cached: list[DataFrame] = field(default_factory=list)


Step = Callable[[DataFrame, DataFrame | None], Done]


def _marked(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
    new = rows.withColumn(ROUND, F.lit(1))
    if carried is None:
        return new
    return carried.withColumn(ROUND, F.lit(0)).unionByName(new, allowMissingColumns=True)


def _tail(both: DataFrame, n: int, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last ``n`` rows of every key. The rank is limited on the map side too."""
    back = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (ROUND, *order)])
    ranked = both.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= n)
    return ranked.select(*columns)


@dataclass(frozen=True)
class Fill:
    """``latest_fill`` on a stream that holds events (side 1) and updates (side 0).

    The state is the latest update of every key.
    """

    keys: Sequence[str] = tuple(AREA_KEYS)
    order: Sequence[str] = ("seq",)
    fields: Sequence[str] = tuple(WEATHER)
    present: str | None = None
    max_rows: int = MAX_ROWS

    @staticmethod
    def both(events: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
        """Both streams as one, under a side tag."""
        right = updates.select(*keys, *order, *fields).withColumn(SIDE, F.lit(0))
        return events.withColumn(SIDE, F.lit(1)).unionByName(right, allowMissingColumns=True)

    def __call__(self, batch: DataFrame, carried: DataFrame | None) -> Done:
        order = (ROUND, *self.order)
        new = batch.where(F.col(SIDE) == 0).select(*self.keys, *self.order, *self.fields)
        updates = _marked(new, carried)
        events = batch.where(F.col(SIDE) == 1).drop(SIDE).withColumn(ROUND, F.lit(1))
        places = events.select(*self.keys, *order).unionByName(updates.select(*self.keys, *order))
        layout = SeriesLayout.measure(places, self.keys, order, self.max_rows)
        filled = latest_fill(events, updates, self.keys, order, self.fields, self.present, layout)
        columns = [*self.order, *self.fields]
        newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("_newest")
        state = updates.groupBy(*self.keys).agg(newest)
        return Done(filled.drop(ROUND), state.select(*self.keys, *[F.col(f"_newest.{c}").alias(c) for c in columns]))


@dataclass(frozen=True)
class Windows:
    """``enrich_series`` on a stream. The state is the last rows of every key."""

    lags: Mapping[str, str] = field(default_factory=lambda: LAGS)
    rolling: Mapping[str, str] = field(default_factory=lambda: ROLLING)
    n: int = 3
    size: int = 3
    keys: Sequence[str] = tuple(ROUTE_KEYS)
    order: Sequence[str] = ("seq",)
    time_text: str = "timestamp"
    full_only: bool = True
    emit_order: str | None = None
    max_rows: int = MAX_ROWS

    def __call__(self, batch: DataFrame, carried: DataFrame | None) -> Done:
        derived = {f"{p}_{k}" for p in self.lags.values() for k in range(1, self.n + 1)} | {*self.rolling.values()}
        columns = [c for c in batch.columns if c not in derived]
        order = (ROUND, *self.order)
        both = _marked(batch.select(*columns), carried)
        layout = SeriesLayout.measure(both.select(*self.keys, *order), self.keys, order, self.max_rows)
        emitted = {ROUND: "_emit_round"} | ({self.order[0]: self.emit_order} if self.emit_order else {})
        rows = enrich_series(
            both, self.lags, self.rolling, self.n, self.size, self.keys, order, self.time_text, self.full_only,
            emitted, layout,
        )
        # A carried row has been emitted by the batch it came with.
        rows = rows.where(F.col("_emit_round") == 1).drop("_emit_round", ROUND)
        return Done(rows, _tail(both, self.n + self.size - 1, self.keys, self.order, columns))


@dataclass(frozen=True)
class Congestion:
    """``congestion_alerts`` on a stream. The state is the open run of every route."""

    speed: float = 10.0
    events: int = 3
    minutes: int = 30
    order: Sequence[str] = ("seq",)
    max_rows: int = MAX_ROWS

    def columns(self, batch: DataFrame) -> list[str]:
        extra = ["ingested_at"] if "ingested_at" in batch.columns else []
        return [*self.order, *ROUTE_KEYS, "timestamp", "avg_speed", "vehicle_count", *extra]

    def __call__(self, batch: DataFrame, carried: DataFrame | None) -> Done:
        rows = batch.select(*self.columns(batch))
        layout = SeriesLayout.measure(rows, ROUTE_KEYS, self.order, self.max_rows)
        # Two answers come from the runs, so they are computed once.
        runs = speed_runs(rows, self.speed, ROUTE_KEYS, self.order, layout, carried).persist()
        alerts = congestion_from_runs(runs.where("_low"), self.speed, self.events, self.minutes, self.order)
        return Done(alerts, open_runs(runs, ROUTE_KEYS, self.order, carried), [runs])


@dataclass(frozen=True)
class Accidents:
    """``accident_alerts`` on a stream. The state is the last rows of every route."""

    history: int = 6
    multiplier: float = 3.0
    order: Sequence[str] = ("seq",)
    max_rows: int = MAX_ROWS

    def columns(self, batch: DataFrame) -> list[str]:
        return [*self.order, *ROUTE_KEYS, "timestamp", "accident_count", "avg_speed", "vehicle_count"]

    def __call__(self, batch: DataFrame, carried: DataFrame | None) -> Done:
        columns = self.columns(batch)
        order = (ROUND, *self.order)
        both = _marked(batch.select(*columns), carried)
        layout = SeriesLayout.measure(both, ROUTE_KEYS, order, self.max_rows)
        alerts = accident_alerts(both, self.history, self.multiplier, order, layout)
        alerts = alerts.where(F.col(ROUND) == 1).drop(ROUND)
        return Done(alerts, _tail(both, self.history, ROUTE_KEYS, self.order, columns))


# -- jobs --------------------------------------------------------------------------


@dataclass(frozen=True)
class CarriedJob:
    """Steps, one after the other, on every micro-batch of a stream.

    ``finish`` shapes the rows that are written; ``source`` reads the rows of a
    micro-batch where the stream itself only names them (a ``BatchTable``). A first step
    that has ``columns`` gets these only, so that no others are computed and cached.
    """

    steps: Sequence[Step]
    table: BatchTable
    folder: str
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
    source: Callable[[DataFrame], DataFrame] = lambda batch: batch

    def states(self, spark: SparkSession) -> list[StateTable]:
        return [StateTable(spark, f"{self.folder}/state-{i}") for i in range(len(self.steps))]

    def run(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: rows, then state. Running it again changes nothing."""
        states = self.states(batch.sparkSession)
        rows = self.source(batch)
        if hasattr(self.steps[0], "columns"):
            rows = rows.select(*self.steps[0].columns(rows))
        rows = rows.persist()
        cached, after = [rows], []
        try:
            for i, (step, state) in enumerate(zip(self.steps, states, strict=True)):
                done = step(rows, state.before(batch_id))
                rows = done.rows
                if i + 1 < len(self.steps):  # read by the next step's rows and by its state
                    rows = rows.persist()
                    cached.append(rows)
                cached += done.cached
                after.append(done.state)
            self.table.write(batch_id, self.finish(rows))
            for state, new in zip(states, after, strict=True):
                state.write(batch_id, new)
        finally:
            for df in cached:
                df.unpersist()

    def start(self, stream: DataFrame, once: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.run).option("checkpointLocation", f"{self.folder}/checkpoint")
        return (writer.trigger(availableNow=True) if once else writer).start()
