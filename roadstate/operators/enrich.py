"""Event enrichment: weather fill, look-back features, count windows, facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstate.operators.series import (
    HALO,
    SEGMENT,
    SeriesLayout,
    layout_for,
    running_last,
    series_rank,
)
from roadstate.schemas import AREA_KEYS, LAGS, ROLLING, ROUTE_KEYS, WEATHER

_UPDATE, _SIDE = "_update", "_side"


def latest_fill(
    events: DataFrame,
    updates: DataFrame,
    keys: Sequence[str] = tuple(AREA_KEYS),
    order: Sequence[str] = ("seq",),
    fields: Sequence[str] = tuple(WEATHER),
    present: str | None = None,
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Fill absent fields of each event from the latest update of its key.

    "Latest" is by arrival (``order``); at equal arrival the update goes first.
    ``present`` names an array column with the fields the record did carry:
    those keep their value even when it is null. Without it, null means absent.
    An event with no update before it stays unfilled.

    One tagged union and one running value instead of a range join, so the work
    is linear in both inputs.
    """
    tag = F.struct(*[F.col(c) for c in fields])
    right = updates.select(*keys, *order, tag.alias(_UPDATE), F.lit(0).alias(_SIDE))
    left = events.withColumn(_SIDE, F.lit(1))
    both = left.unionByName(right, allowMissingColumns=True)
    filled = running_last(both, _UPDATE, keys, (*order, _SIDE), layout)
    rows = filled.where(F.col(_SIDE) == 1)

    def value(field: str) -> Column:
        latest = F.col(f"{_UPDATE}.{field}")
        if field not in events.columns:
            return latest
        own = F.col(field)
        if present is None:
            return F.coalesce(own, latest.cast(events.schema[field].dataType))
        carried = F.coalesce(F.array_contains(present, field), F.lit(False))
        return F.when(carried, own).otherwise(latest.cast(events.schema[field].dataType))

    return rows.withColumns({f: value(f) for f in fields}).drop(_UPDATE, _SIDE)


def _lag_columns(cols: Mapping[str, str], n: int, window) -> dict[str, Column]:
    return {
        f"{prefix}_{k}": F.lag(F.col(source).cast("double"), k).over(window)
        for source, prefix in cols.items()
        for k in range(1, n + 1)
    }


def with_lags(
    df: DataFrame,
    cols: Mapping[str, str] = LAGS,
    n: int = 3,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Add the previous ``n`` values, by arrival, of each listed column."""
    layout = layout_for(df, keys, order, layout)
    rows = layout.with_halo(df, n)
    return layout.without_halo(rows.withColumns(_lag_columns(cols, n, layout.window())))


def _window_columns(
    df: DataFrame,
    cols: Mapping[str, str],
    size: int,
    window,
    time_text: str,
    full_only: bool,
    emitted: Mapping[str, str],
) -> DataFrame:
    """The last ``size`` arrivals of each row as one emitted record.

    The emitted record is the one with the greatest text time (an absent time
    sorts first, the later arrival wins a tie), joined by the means of the
    window. ``emitted`` renames columns of the arriving row that goes with it.
    """
    frame = window.rowsBetween(1 - size, 0)
    # Bookkeeping columns belong to the arriving row, whatever is emitted.
    own = [c for c in (SEGMENT, HALO) if c in df.columns]
    added = [*cols.values(), *emitted.values()]
    record = [c for c in df.columns if c not in own and c not in added]
    back = range(1, size)
    # One window node; columns that are not used later are pruned from it.
    staged = df.withColumn("_time", F.coalesce(F.col(time_text).cast("string"), F.lit(""))).select(
        *[F.col(c) for c in [*own, *record, "_time"]],
        *[F.avg(F.col(c).cast("double")).over(frame).alias(name) for c, name in cols.items()],
        *[F.col(c).alias(name) for c, name in emitted.items()],
        *[F.lag(c, i).over(window).alias(f"_back{i}_{c}") for i in back for c in [*record, "_time"]],
        F.count(F.lit(1)).over(frame).alias("_filled"),
    )
    if full_only:
        staged = staged.where(F.col("_filled") == size)

    def later(best: tuple[Column, Column], i: int) -> tuple[Column, Column]:
        """How far back the latest time lies; a tie stays with the later arrival."""
        age, time = best
        wins = F.col(f"_back{i}__time") > time
        return F.when(wins, i).otherwise(age), F.when(wins, F.col(f"_back{i}__time")).otherwise(time)

    age, _ = reduce(later, back, (F.lit(0), F.col("_time")))
    aged = staged.withColumn("_age", age)

    def emit(c: str) -> Column:
        pick = reduce(
            lambda found, i: found.when(F.col("_age") == i, F.col(f"_back{i}_{c}")), back,
            F.when(F.col("_age") == 0, F.col(c)),
        )
        return pick.alias(c)

    return aged.select(*map(emit, record), *added, *own)


def count_window(
    df: DataFrame,
    cols: Mapping[str, str] = ROLLING,
    size: int = 3,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    time_text: str = "timestamp",
    full_only: bool = True,
    emit_order: str | None = None,
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Sliding count window with slide 1; with ``full_only`` the first
    ``size - 1`` arrivals of a series emit nothing.

    A record can be emitted again by later arrivals, so its own order column is
    not the order of emission; ``emit_order`` names a column for that (the first
    order column of the arriving row).
    """
    layout = layout_for(df, keys, order, layout)
    rows = layout.with_halo(df, size - 1)
    emitted = {order[0]: emit_order} if emit_order else {}
    return layout.without_halo(
        _window_columns(rows, cols, size, layout.window(), time_text, full_only, emitted)
    )


def enrich_series(
    df: DataFrame,
    lags: Mapping[str, str] = LAGS,
    rolling: Mapping[str, str] = ROLLING,
    n: int = 3,
    size: int = 3,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    time_text: str = "timestamp",
    full_only: bool = True,
    emit_order: str | Mapping[str, str] | None = None,
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """``with_lags`` then ``count_window`` on one shuffle and one sort.

    The emitted record may be one of the ``size - 1`` rows before a segment, and
    its lags reach ``n`` rows further back, hence the longer halo. ``emit_order`` names a
    column for the first order column of the arriving row, or maps several of its
    columns to names.
    """
    layout = layout_for(df, keys, order, layout)
    rows = layout.with_halo(df, n + size - 1)
    lagged = rows.withColumns(_lag_columns(lags, n, layout.window()))
    emitted = {order[0]: emit_order} if isinstance(emit_order, str) else emit_order or {}
    return layout.without_halo(
        _window_columns(lagged, rolling, size, layout.window(), time_text, full_only, emitted)
    )


def merge_facets(
    *facets: DataFrame,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Join the k-th record of every facet of a series; a later facet wins."""
    ranked = [
        series_rank(f, keys, order, "position", layout_for(f, keys, order, layout)).drop(*order)
        for f in facets
    ]
    on = [*keys, "position"]
    merged = ranked[0]
    for part in ranked[1:]:
        shared = [c for c in part.columns if c in merged.columns and c not in on]
        joined = merged.join(part.withColumnsRenamed({c: f"_new_{c}" for c in shared}), on)
        merged = joined.withColumns(
            {c: F.coalesce(f"_new_{c}", c) for c in shared}
        ).drop(*[f"_new_{c}" for c in shared])
    return merged


def first_seen(
    df: DataFrame,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    columns: Sequence[str] = (),
) -> DataFrame:
    """One row per key, with the listed columns of its first record.

    An aggregate rather than a window: copies of a key collapse before the
    shuffle.
    """
    first = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min(c).alias(f"first_{c}") for c in order[:1]],
        *[F.min_by(c, first).alias(c) for c in columns],
    )


def latest_row(
    df: DataFrame,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[Column] = (),
) -> DataFrame:
    """The first row of every key under ``order``.

    The rank filter is applied on the map side too (group limit), so a hot key
    sends one row per task to the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_non_null(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("event_ts", "seq"),
    last: str = "last_event_time",
) -> DataFrame:
    """Latest non-null value of each column, possibly from different rows.

    ``max`` over (order, value) pairs rather than ``max_by``: it builds one pair
    per value, about half the cost, and rows of equal order cannot make the
    result vary.
    """

    def newest(c: str) -> Column:
        pair = F.struct(*order, F.col(c).alias("_value"))
        return F.max(F.when(F.col(c).isNotNull(), pair))["_value"]

    return df.groupBy(*keys).agg(
        *[newest(c).alias(c) for c in columns], F.max(order[0]).alias(last)
    )
