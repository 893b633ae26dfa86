"""Ordered series per key, cut so that no key has to fit into one task.

Every order-sensitive operator of the package (look-back, running state, rank,
latest value) works on *series*: the rows of one key in arrival order. A plain
``Window.partitionBy(key)`` sends a whole series to one task, which stops
working once a single key holds a large share of the data. ``SeriesLayout``
measures the keys first (one narrow aggregate with map-side combine):

* no key above the row limit: windows partition by the key alone, one shuffle;
* some keys above it: only those are cut into *segments*, consecutive ranges of
  the whole order tuple holding about the row limit each, so rows tied in the first
  order column are cut by the next ones. Windows then partition by
  ``(key, segment)``. What a segment has to know about the rows before it
  travels either as a *halo* (copies of the last n rows, for bounded frames) or
  as a *carry* (one summary row per segment, for unbounded state).

Results do not depend on where the cuts fall; only the balance does.

Bounds: the row limit is raised to ``total / MAX_HOT_KEYS``, so by pigeonhole
there are fewer than ``MAX_HOT_KEYS`` hot keys, and their broadcast is bounded.
The cut points are at most ``MAX_SEGMENTS`` order tuples, chosen from a sample of at
most about ``MAX_SAMPLE``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadstate.schemas import ROUTE_KEYS

MAX_ROWS = 5_000_000
MAX_HOT_KEYS = 100_000
MAX_SEGMENTS = 20_000
SAMPLES_PER_SEGMENT = 20
MAX_SAMPLE = 100_000

SEGMENT = "_segment"
HALO = "_halo"
_HOT = "_hot"
#: All digits of a time, so that a cut point is read back as it was written.
_AS_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def same_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys; null equals null, so records without a key are a series, too."""
    theirs = {k: f"_same_{k}" for k in keys}
    renamed = other.withColumnsRenamed(theirs)
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(t)) for k, t in theirs.items()])
    return df.join(renamed, match, how).drop(*theirs.values())


@dataclass(frozen=True)
class Cuts:
    """Cut points of split series: sorted order tuples, as one JSON text."""

    columns: tuple[str, ...]
    schema: str
    points: str
    count: int

    @classmethod
    def choose(cls, positions: DataFrame, columns: tuple[str, ...], segments: int) -> Cuts:
        """``segments - 1`` points at equal steps through a sample of order tuples."""
        tuples = positions.select(*columns)
        found = tuples.orderBy(*columns).collect()
        at = {len(found) * i // segments for i in range(1, segments)}
        chosen = tuples.sparkSession.createDataFrame([found[i] for i in sorted(at) if i < len(found)], tuples.schema)
        text = chosen.distinct().agg(F.to_json(F.collect_list(F.struct(*columns)), _AS_TEXT).alias("p")).first()["p"]
        fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in tuples.schema)
        return cls(columns, f"array<struct<{fields}>>", text, len(at))

    def segment(self) -> Column:
        """Number of cut points at or before the row, by binary search.

        The list is a constant of the plan. The search is a fold over falling powers of
        two: a step is taken when the point it leads to is not above the row.
        """
        points = F.sort_array(F.from_json(F.lit(self.points), self.schema, _AS_TEXT))
        row = F.struct(*self.columns)
        steps = [1 << i for i in reversed(range(max(1, self.count.bit_length())))]

        def step(at: Column, size: Column) -> Column:
            return F.when(F.get(points, at + size - 1) <= row, at + size).otherwise(at)

        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


@dataclass(frozen=True)
class SeriesLayout:
    """How the series of one data set are spread over tasks."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None = None
    cuts: Cuts | None = None

    @classmethod
    def measure(
        cls,
        df: DataFrame,
        keys: Sequence[str] = tuple(ROUTE_KEYS),
        order: Sequence[str] = ("seq",),
        max_rows: int = MAX_ROWS,
    ) -> SeriesLayout:
        """Find the keys above ``max_rows`` rows and the cut points for them."""
        keys, order = tuple(keys), tuple(order)
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        total, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
        limit = max(max_rows, ceil((total or 0) / MAX_HOT_KEYS))
        if not total or largest <= limit:
            return cls(keys, order)

        # Fewer than MAX_HOT_KEYS rows by the choice of the limit.
        found = sizes.where(F.col("_n") > limit).collect()
        hot_rows = sum(row["_n"] for row in found)
        schema = T.StructType(
            [T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField(_HOT, T.BooleanType())]
        )
        hot = df.sparkSession.createDataFrame(
            [tuple(row[k] for k in keys) + (True,) for row in found], schema
        )
        segments = min(MAX_SEGMENTS, ceil(hot_rows / limit) + 1)
        # Cut points only steer the balance, so a sample is enough to place
        # them; every row is kept whatever they are.
        fraction = min(1.0, min(SAMPLES_PER_SEGMENT * segments, MAX_SAMPLE) / hot_rows)
        positions = same_keys(df, F.broadcast(hot), keys, "inner").select(*order)
        if fraction < 1.0:
            positions = positions.sample(fraction, seed=11)
        return cls(keys, order, hot, Cuts.choose(positions, order, segments))

    @property
    def split(self) -> bool:
        return self.hot is not None

    @property
    def group(self) -> list[str]:
        """The columns that identify a unit of work."""
        return [*self.keys, SEGMENT] if self.split else list(self.keys)

    def window(self, *order: Column | str):
        return Window.partitionBy(*self.group).orderBy(*(order or self.order))

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the segment number (null for keys that stay whole)."""
        if not self.split:
            return df
        marked = same_keys(df, F.broadcast(self.hot), self.keys, "left")
        return marked.withColumn(SEGMENT, F.when(F.col(_HOT), self.cuts.segment())).drop(_HOT)

    def with_halo(self, df: DataFrame, rows: int) -> DataFrame:
        """Give every segment a copy of the ``rows`` rows before it.

        Copies carry ``_halo = true`` and are removed by ``without_halo``.
        """
        if not self.split or rows == 0:
            return self.assign(df)
        body = self.assign(df)
        newest_first = [F.col(c).desc_nulls_last() for c in self.order]
        tails = (
            body.where(F.col(SEGMENT).isNotNull())
            .withColumn("_back", F.row_number().over(self.window(*newest_first)))
            .where(F.col("_back") <= rows)
            .drop("_back")
        )
        # The tails of one key number at most rows * MAX_SEGMENTS. A tail row is
        # wanted by every later segment among the next ``rows`` tail rows.
        ahead = (
            Window.partitionBy(*self.keys)
            .orderBy(SEGMENT, *self.order)
            .rowsBetween(1, rows)
        )
        wanted = F.filter(F.collect_set(SEGMENT).over(ahead), lambda s: s > F.col(SEGMENT))
        copies = (
            tails.withColumn("_wanted", wanted)
            .withColumn(SEGMENT, F.explode("_wanted"))
            .drop("_wanted")
            .withColumn(HALO, F.lit(True))
        )
        return body.withColumn(HALO, F.lit(False)).unionByName(copies)

    def without_halo(self, df: DataFrame) -> DataFrame:
        """Drop the copies and the bookkeeping columns."""
        if HALO in df.columns:
            df = df.where(~F.col(HALO))
        return df.drop(HALO, SEGMENT)

    def attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        """Left join one summary row per ``(key, segment)``.

        The summary is small (segments, not rows); Spark broadcasts it when its
        measured size allows and shuffles by ``(key, segment)`` otherwise.
        """
        return same_keys(df, carry, self.group, "left")

    def segments(self, df: DataFrame, *aggregates: Column) -> DataFrame:
        """Summarise the rows of split keys per segment (map-side combined)."""
        return df.where(F.col(SEGMENT).isNotNull()).groupBy(*self.group).agg(*aggregates)

    def earlier_segments(self):
        """Frame over the summary rows before the current segment."""
        return (
            Window.partitionBy(*self.keys)
            .orderBy(SEGMENT)
            .rowsBetween(Window.unboundedPreceding, -1)
        )


def layout_for(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    layout: SeriesLayout | None = None,
) -> SeriesLayout:
    """Reuse ``layout`` when it fits, otherwise measure ``df``.

    Segments cut by some order are ranges of every order that begins with it.
    """
    if layout is not None and layout.keys == tuple(keys):
        cut = layout.cuts.columns if layout.cuts else ()
        if tuple(order)[: len(cut)] == cut:
            return replace(layout, order=tuple(order))
    return SeriesLayout.measure(df, keys, order)


def series_rank(
    df: DataFrame,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    name: str = "position",
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """1-based position of each row in its series."""
    layout = layout_for(df, keys, order, layout)
    rows = layout.assign(df)
    local = F.row_number().over(layout.window()).cast("long")
    if not layout.split:
        return rows.withColumn(name, local)
    sizes = layout.segments(rows, F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        *layout.group, F.sum("_size").over(layout.earlier_segments()).alias("_before")
    )
    ranked = layout.attach(rows.withColumn(name, local), starts)
    total = F.col(name) + F.coalesce(F.col("_before"), F.lit(0))
    return ranked.withColumn(name, total).drop("_before", SEGMENT)


def running_last(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Replace ``value`` by its latest non-null value up to and including the row."""
    layout = layout_for(df, keys, order, layout)
    rows = layout.assign(df)
    so_far = layout.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.last(value, ignorenulls=True).over(so_far)
    if not layout.split:
        return rows.withColumn(value, local)
    pair = F.struct(*layout.order, F.col(value).alias("_value"))
    newest = F.max(F.when(F.col(value).isNotNull(), pair))["_value"]
    summary = layout.segments(rows, newest.alias("_newest"))
    carry = summary.select(
        *layout.group,
        F.last("_newest", ignorenulls=True).over(layout.earlier_segments()).alias("_carried"),
    )
    joined = layout.attach(rows.withColumn(value, local), carry)
    return joined.withColumn(value, F.coalesce(F.col(value), F.col("_carried"))).drop(
        "_carried", SEGMENT
    )


def running_sum(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Replace ``value`` by its sum up to and including the row."""
    layout = layout_for(df, keys, order, layout)
    rows = layout.assign(df)
    so_far = layout.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.sum(value).over(so_far)
    if not layout.split:
        return rows.withColumn(value, local)
    sums = layout.segments(rows, F.sum(value).alias("_sum"))
    carry = sums.select(
        *layout.group, F.sum("_sum").over(layout.earlier_segments()).alias("_carried")
    )
    joined = layout.attach(rows.withColumn(value, local), carry)
    total = F.col(value) + F.coalesce(F.col("_carried"), F.lit(0))
    return joined.withColumn(value, total).drop("_carried", SEGMENT)
