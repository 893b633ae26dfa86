"""Alert rules over enriched events, in batch form.

Both rules follow arrival order. The look-back rule needs a bounded frame; the
run rule needs unbounded state, which split series carry between segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstate.functions.scalars import minutes_between, parse_time, severity
from roadstate.operators.series import SEGMENT, SeriesLayout, layout_for, same_keys
from roadstate.schemas import ROUTE_KEYS


def speed_runs(
    df: DataFrame,
    speed: float = 10.0,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Add the low-speed flag, run length and run start to every row.

    A run is a stretch of rows below ``speed``; a missing speed counts as 0.
    The row time comes from ``timestamp``; where it does not parse, from
    ``ingested_at`` or else the current time. Instead of numbering islands, the row that starts a
    run marks its position and time, and the rows after it take the latest
    mark: one sort, and no run has to be collected.

    ``opening`` holds the runs still open before the first row of a key (``keys``,
    ``open_length``, ``open_start``), as ``open_runs`` leaves them for later rows.
    """
    layout = layout_for(df, keys, order, layout)
    window = layout.window()
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fallback = F.col("ingested_at") if "ingested_at" in df.columns else F.localtimestamp()
    rows = layout.assign(df).withColumns(
        {
            "_speed": F.coalesce(F.col("avg_speed").cast("double"), F.lit(0.0)),
            "_ts": F.coalesce(parse_time("timestamp"), fallback),
        }
    )
    rows = rows.withColumn("_low", F.col("_speed") < speed)
    rows = rows.withColumns(
        {
            "_at": F.row_number().over(window).cast("long"),
            "_starts": F.col("_low") & ~F.coalesce(F.lag("_low").over(window), F.lit(False)),
        }
    )
    mark = F.when(F.col("_starts"), F.struct("_at", "_ts"))
    rows = rows.withColumn("_mark", F.last(mark, ignorenulls=True).over(so_far))
    rows = rows.withColumns(
        {
            "run_length": F.col("_at") - F.col("_mark._at") + 1,
            "run_start": F.col("_mark._ts"),
        }
    )
    if opening is not None:
        opening = opening.select(
            *keys, F.col("open_length").alias("_open_length"), F.col("open_start").alias("_open_start")
        )
    if layout.split:
        carry = _carried_runs(rows, layout, opening)
        if opening is not None:
            # Keys that stay whole have no segment number.
            whole = opening.withColumn(SEGMENT, F.lit(None).cast("int"))
            carry = carry.unionByName(whole)
        rows = layout.attach(rows, carry)
    elif opening is not None:
        rows = same_keys(rows, opening, keys, "left")
    if layout.split or opening is not None:
        # Only the run that opens a segment can continue an earlier one.
        continues = F.col("_low") & (F.col("_mark._at") == 1) & (F.col("_open_length") > 0)
        rows = rows.withColumns(
            {
                "run_length": F.col("run_length")
                + F.when(continues, F.col("_open_length")).otherwise(0),
                "run_start": F.when(continues, F.col("_open_start")).otherwise(F.col("run_start")),
            }
        ).drop("_open_length", "_open_start")
    return rows.drop("_at", "_starts", "_mark", SEGMENT)


def low_speed_runs(
    df: DataFrame,
    speed: float = 10.0,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """The low-speed rows of ``speed_runs``."""
    return speed_runs(df, speed, keys, order, layout).where("_low").drop("_low")


def open_runs(
    runs: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    opening: DataFrame | None = None,
) -> DataFrame:
    """``keys``, ``open_length``, ``open_start`` of the runs open after the rows of ``speed_runs``.

    Keys of ``opening`` without rows since then stay as they were.
    """
    newest = F.max_by(F.struct("_low", "run_length", "run_start"), F.struct(*order)).alias("_end")
    last = runs.groupBy(*keys).agg(newest)
    still = last.where("_end._low").select(
        *keys, F.col("_end.run_length").alias("open_length"), F.col("_end.run_start").alias("open_start")
    )
    return still if opening is None else still.unionByName(same_keys(opening, last.select(*keys), keys, "left_anti"))


def _carried_runs(rows: DataFrame, layout: SeriesLayout, opening: DataFrame | None = None) -> DataFrame:
    """Length and start of the run still open when each segment begins.

    What was open before all rows stands before the first segment.
    """
    last = F.max_by(
        F.struct("_low", "run_length", "run_start", F.col("_mark._at").alias("_from")),
        F.struct(*layout.order),
    )
    ends = layout.segments(rows, last.alias("_end")).select(
        *layout.group,
        F.when(F.col("_end._low"), F.col("_end.run_length")).otherwise(0).alias("_trailing"),
        F.when(F.col("_end._low"), F.col("_end.run_start")).alias("_since"),
        # True when the whole segment is one run, so that it passes on what
        # was open before it.
        (F.col("_end._low") & (F.col("_end._from") == 1)).alias("_whole"),
    )
    if opening is not None:
        ends = ends.unionByName(
            opening.select(
                *layout.keys,
                F.lit(-1).alias(SEGMENT),
                F.col("_open_length").alias("_trailing"),
                F.col("_open_start").alias("_since"),
                F.lit(False).alias("_whole"),
            )
        )
    by_segment = Window.partitionBy(*layout.keys).orderBy(SEGMENT)
    so_far = by_segment.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = ends.withColumn("_chain", F.sum(F.when(F.col("_whole"), 0).otherwise(1)).over(so_far))
    along = (
        Window.partitionBy(*layout.keys, "_chain")
        .orderBy(SEGMENT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    open_after = chained.select(
        *layout.group,
        F.sum("_trailing").over(along).alias("_length"),
        F.first("_since", ignorenulls=True).over(along).alias("_start"),
    )
    return open_after.select(
        *layout.group,
        F.lag("_length").over(by_segment).alias("_open_length"),
        F.lag("_start").over(by_segment).alias("_open_start"),
    )


def congestion_rule(speed: float, events: int, minutes: int) -> str:
    return f"{events}_events_or_{minutes}m_avg_speed_lt_{float(speed)}"


def congestion_record(
    speed: float, events: int, minutes: int, count: Column, duration: Column
) -> list[Column]:
    """The columns of a congestion alert."""
    return [
        F.lit("long_congestion").alias("alert_type"),
        severity("congestion", "_speed").alias("severity"),
        *[F.col(c) for c in ROUTE_KEYS],
        F.col("timestamp"),
        F.col("_speed").alias("avg_speed"),
        F.col("vehicle_count"),
        count.alias("low_speed_event_count"),
        F.greatest(duration, F.lit(0)).alias("low_speed_duration_minutes"),
        F.lit(congestion_rule(speed, events, minutes)).alias("rule"),
        F.struct(
            (count >= events).alias("consecutive_events"),
            (duration >= minutes).alias("duration"),
        ).alias("matched_by"),
    ]


def congestion_alerts(
    df: DataFrame,
    speed: float = 10.0,
    events: int = 3,
    minutes: int = 30,
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Alert on every low row once a run has ``events`` rows or ``minutes``."""
    runs = low_speed_runs(df, speed, ROUTE_KEYS, order, layout)
    return congestion_from_runs(runs, speed, events, minutes, order)


def congestion_from_runs(
    runs: DataFrame, speed: float, events: int, minutes: int, order: Sequence[str]
) -> DataFrame:
    """The alerts among low-speed rows with their run length and start."""
    count, duration = F.col("run_length"), minutes_between("run_start", "_ts")
    fired = runs.where((count >= events) | (duration >= minutes))
    return fired.select(*order, *congestion_record(speed, events, minutes, count, duration))


def accident_rule(multiplier: float) -> str:
    return f"current_gt_0_and_spike_multiplier_{float(multiplier)}"


def accident_conditions(
    current: Column, mean: Column, peak: Column, multiplier: float
) -> dict[str, Column]:
    return {
        "first_accident_after_clean_history": (current > 0) & (peak == 0),
        "spike_vs_history": (current > 0) & (current >= F.greatest(F.lit(1.0), mean * multiplier)),
        "multi_accident": current >= 2,
    }


def accident_alerts(
    df: DataFrame,
    history: int = 6,
    multiplier: float = 3.0,
    order: Sequence[str] = ("seq",),
    layout: SeriesLayout | None = None,
) -> DataFrame:
    """Alert on accident counts against the previous ``history`` rows."""
    if history < 1:
        raise ValueError("history must be at least 1")
    layout = layout_for(df, ROUTE_KEYS, order, layout)
    rows = layout.with_halo(df, history)
    current = F.coalesce(F.col("accident_count").cast("double"), F.lit(0.0)).cast("long")
    rows = rows.withColumn("_current", current)
    before = layout.window().rowsBetween(-history, -1)
    rows = rows.withColumns(
        {
            "_mean": F.coalesce(F.avg("_current").over(before), F.lit(0.0)),
            "_peak": F.coalesce(F.max("_current").over(before), F.lit(0)),
        }
    )
    rows = layout.without_halo(rows)
    rules = accident_conditions(F.col("_current"), F.col("_mean"), F.col("_peak"), multiplier)
    first, spike, multi = rules.values()
    return rows.where(first | spike | multi).select(
        *order,
        F.lit("accident_anomaly").alias("alert_type"),
        severity("accident", "_current").alias("severity"),
        *ROUTE_KEYS,
        "timestamp",
        F.col("_current").alias("accident_count"),
        F.round("_mean", 3).alias("history_avg_accident_count"),
        F.col("_peak").alias("history_max_accident_count"),
        "avg_speed",
        "vehicle_count",
        F.lit(accident_rule(multiplier)).alias("rule"),
        F.struct(*[c.alias(name) for name, c in rules.items()]).alias("matched_by"),
    )
