"""Keyed streaming forms of the stateful operators, scoring, and the chained topology.

The keyed forms hold their state in Spark's state store and suit many small keys: what a
key brings in one micro-batch is one pandas frame, bounded by the rate option of the
source. ``streaming.carried`` has the forms for keys of any size, which the chained
topology uses.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from roadstate.functions.scalars import HIGH_SEVERITY_ACCIDENTS, HIGH_SEVERITY_SPEED, parse_time
from roadstate.operators.clusters import StateModel
from roadstate.operators.normalize import normalize_alerts, normalize_predictions
from roadstate.operators.rules import accident_rule, congestion_rule
from roadstate.operators.scoring import score
from roadstate.schemas import (
    ACCIDENT_SCHEMA,
    AREA_KEYS,
    CONGESTION_SCHEMA,
    LAGS,
    ROLLING,
    ROUTE_KEYS,
    WEATHER,
)
from roadstate.session import ROCKSDB
from roadstate.streaming.carried import Accidents, BatchTable, CarriedJob, Congestion, Fill, Windows
from roadstate.streaming.processors import CARRIED, SIDE, AccidentDetector, CongestionDetector, LagWindow, LatestFill


# Order in which enriched records leave the count window.
EMITTED = "emit_seq"
# Fixed value: records between two looks at the model alias.
REFRESH_RECORDS = 300


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _stateful(df: DataFrame, keys: Sequence[str], processor, output: T.StructType) -> DataFrame:
    use_state_store(df.sparkSession)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="None"
    )


def _order_fields(df: DataFrame, order: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in order]


def latest_fill_stream(
    events: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = tuple(AREA_KEYS),
    order: Sequence[str] = ("seq",),
    fields: Sequence[str] = tuple(WEATHER),
    present: str | None = None,
) -> DataFrame:
    """Stream form of ``latest_fill``: both inputs merged under a side tag."""
    left = events.withColumn(SIDE, F.lit(1))
    right = updates.select(*keys, *order, *fields).withColumn(SIDE, F.lit(0))
    both = left.unionByName(right, allowMissingColumns=True)
    output = T.StructType([both.schema[c] for c in both.columns if c != SIDE])
    if present is not None:
        flags = {f"{CARRIED}{f}": F.coalesce(F.array_contains(present, f), F.lit(False)) for f in fields}
        both = both.withColumns(flags)
    return _stateful(both, keys, LatestFill(output, fields, order, present), output)


def enrich_stream(
    df: DataFrame,
    lags: Mapping[str, str] = LAGS,
    rolling: Mapping[str, str] = ROLLING,
    n: int = 3,
    size: int = 3,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    time_text: str = "timestamp",
    full_only: bool = True,
    emit_order: str | None = None,
) -> DataFrame:
    """Stream form of ``enrich_series``."""
    derived = [f"{p}_{k}" for p in lags.values() for k in range(1, n + 1)] + list(rolling.values())
    record = T.StructType([f for f in df.schema.fields if f.name not in derived])
    emitted = {order[0]: emit_order} if emit_order else {}
    output = T.StructType(
        record.fields
        + [T.StructField(c, T.DoubleType()) for c in derived]
        + [T.StructField(name, df.schema[c].dataType) for c, name in emitted.items()]
    )
    processor = LagWindow(record, output, lags, rolling, order, n, size, time_text, full_only, emitted)
    return _stateful(df.select(*record.names), keys, processor, output)


def congestion_alerts_stream(
    df: DataFrame, speed: float = 10.0, events: int = 3, minutes: int = 30, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """Stream form of ``congestion_alerts``."""
    fallback = F.col("ingested_at") if "ingested_at" in df.columns else F.localtimestamp()
    rows = df.select(
        *order, *ROUTE_KEYS, "timestamp", "avg_speed", "vehicle_count",
        F.coalesce(parse_time("timestamp"), fallback).alias("row_time"),
    )
    output = T.StructType([*_order_fields(df, order), *CONGESTION_SCHEMA.fields])
    rule = congestion_rule(speed, events, minutes)
    processor = CongestionDetector(order, speed, events, minutes, rule, HIGH_SEVERITY_SPEED)
    return _stateful(rows, ROUTE_KEYS, processor, output)


def accident_alerts_stream(
    df: DataFrame, history: int = 6, multiplier: float = 3.0, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """Stream form of ``accident_alerts``."""
    if history < 1:
        raise ValueError("history must be at least 1")
    rows = df.select(*order, *ROUTE_KEYS, "timestamp", "accident_count", "avg_speed", "vehicle_count")
    output = T.StructType([*_order_fields(df, order), *ACCIDENT_SCHEMA.fields])
    processor = AccidentDetector(order, history, multiplier, accident_rule(multiplier), HIGH_SEVERITY_ACCIDENTS)
    return _stateful(rows, ROUTE_KEYS, processor, output)


class Scorer:
    """Scores micro-batches with a snapshot and a model that are read again while the stream runs.

    The snapshot is read again when its version has changed. The model is read again when
    ``refresh_records`` records have gone by since the last multiple of it, so neither
    small nor large micro-batches change how often that happens; a batch has one model.
    A version that is the same as before is not loaded again. Micro-batches come cached:
    they are counted before they are scored.
    """

    def __init__(
        self,
        load_snapshot: Callable[[], DataFrame | None],
        load_model: Callable[[], StateModel | None],
        snapshot_version: Callable[[], object] | None = None,
        model_version: Callable[[], object] | None = None,
        refresh_records: int = REFRESH_RECORDS,
    ):
        if refresh_records < 1:
            raise ValueError("refresh_records must be at least 1")
        self.loads = {"snapshot": load_snapshot, "model": load_model}
        self.versions = {"snapshot": snapshot_version, "model": model_version}
        self.refresh_records = refresh_records
        self.seen = 0  # records before the current micro-batch
        self.turn = -1  # multiples of ``refresh_records`` gone by at the last look
        self.held: dict[str, tuple[object, object]] = {}

    def _current(self, name: str) -> object:
        version = self.versions[name]
        now = object() if version is None else version()
        if name not in self.held or self.held[name][0] != now:
            self.held[name] = (now, self.loads[name]())
        return self.held[name][1]

    def __call__(self, batch: DataFrame, *extra: str) -> DataFrame:
        turn = self.seen // self.refresh_records
        if turn != self.turn or "model" not in self.held:
            self._current("model")
            self.turn = turn
        self.seen += batch.count()
        routes = batch.select(*ROUTE_KEYS).distinct()
        return score(batch, self._current("snapshot"), self.held["model"][1], *extra, routes=routes)


def score_stream(
    events: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    load_snapshot: Callable[[], DataFrame | None],
    load: Callable[[], StateModel | None],
    *extra: str,
    once: bool = False,
    scorer: Scorer | None = None,
    source: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Score every micro-batch; without ``scorer``, snapshot and model are read each time.

    ``source`` reads the rows of a micro-batch where the stream only names them.
    """
    scorer = scorer or Scorer(load_snapshot, load, refresh_records=1)

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = source(batch).persist()
        try:
            sink(scorer(rows, *extra), batch_id)
        finally:
            rows.unpersist()

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to Parquet files under its own checkpoint."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


@dataclass
class Pipeline:
    """The chained topology: raw → enriched → alerts, predictions.

    ``sensors`` and ``weather`` are typed streams with an arrival order. Every stage is a
    query of its own with its own checkpoint and state, and writes a table below ``root``
    batch by batch; later stages stream the manifest of the enriched table, as
    independent consumers. A stage that is stopped goes on where it was.

    ``scorer`` replaces the one made of ``load_snapshot`` and ``load_model``.
    """

    spark: SparkSession
    root: str
    sensors: DataFrame
    weather: DataFrame
    order: Sequence[str] = ("seq",)
    present: str | None = None
    load_snapshot: Callable[[], DataFrame | None] = lambda: None
    load_model: Callable[[], StateModel | None] = lambda: None
    scorer: Scorer | None = None
    batches_per_trigger: int = 1

    def path(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def table(self, name: str) -> BatchTable:
        return BatchTable(self.spark, self.path(name), f"{self.root}/manifests/{name}")

    def _folder(self, stage: str) -> str:
        return f"{self.root}/stages/{stage}"

    def _both(self) -> DataFrame:
        return Fill.both(self.sensors, self.weather, AREA_KEYS, self.order, WEATHER)

    def _enriching(self) -> list:
        return [Fill(order=self.order, present=self.present), Windows(order=self.order, emit_order=EMITTED)]

    def enriched_schema(self) -> T.StructType:
        rows = self.spark.createDataFrame([], self._both().schema)
        for step in self._enriching():
            rows = step(rows, None).rows
        return rows.schema

    def start_enrich(self, once: bool = False, table: BatchTable | None = None) -> StreamingQuery:
        table = table or self.table("enriched_events")
        return CarriedJob(self._enriching(), table, self._folder("enrich")).start(self._both(), once)

    def start_consumers(self, once: bool = False) -> list[StreamingQuery]:
        enriched, schema = self.table("enriched_events"), self.enriched_schema()

        def rows_of(numbers: DataFrame) -> DataFrame:
            return enriched.load(numbers, schema)

        def shaped(name: str) -> Callable[[DataFrame], DataFrame]:
            return lambda alerts: normalize_alerts(as_json(alerts.drop(EMITTED)), name)

        steps = {"congestion": Congestion(order=(EMITTED,)), "accident": Accidents(order=(EMITTED,))}
        queries = [
            CarriedJob(
                [step], self.table(f"traffic_alerts/feed={name}"), self._folder(name), shaped(name), rows_of
            ).start(enriched.stream(self.batches_per_trigger), once)
            for name, step in steps.items()
        ]
        predictions = self.table("traffic_predictions")

        def sink(batch: DataFrame, batch_id: int) -> None:
            predictions.write(batch_id, normalize_predictions(as_json(batch)))

        queries.append(
            score_stream(
                enriched.stream(self.batches_per_trigger), sink, f"{self._folder('score')}/checkpoint",
                self.load_snapshot, self.load_model, once=once, scorer=self.scorer, source=rows_of,
            )
        )
        return queries

    def run_once(self) -> None:
        """Process everything available, stage by stage."""
        self.start_enrich(once=True).awaitTermination()
        for query in self.start_consumers(once=True):
            query.awaitTermination()
