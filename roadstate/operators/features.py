"""Long-term features per route, hour and weekday, and their online snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstate.functions.scalars import now_ntz, online_key, online_route, online_slot, seconds_between
from roadstate.operators.projections import slot_range, valid_events
from roadstate.schemas import LONGTERM_FEATURES, ROUTE_KEYS

# Trailing windows in days, time to live of an online key.
BASELINE_DAYS, SLOT_DAYS = 7, 28
ONLINE_TTL_SECONDS = 90_000

HOURS, WEEKDAYS = 24, 7
#: The route part of the online key, where the table has it.
ONLINE_ROUTE = "online_route"
SLOT_KEYS = [*ROUTE_KEYS, "hour", "day_of_week"]


def source_cutoff(events: DataFrame) -> DataFrame:
    """One row: the latest event time over complete rows (null when none)."""
    return valid_events(events).agg(F.max("event_ts").alias("source_cutoff"))


def distinct_events(events: DataFrame) -> DataFrame:
    """Typed, valid and deduplicated rows; duplicates would shift the means."""
    rows = slot_range(valid_events(events))
    return rows.select(
        "event_ts",
        *ROUTE_KEYS,
        F.col("hour").cast("int").alias("hour"),
        F.col("day_of_week").cast("int").alias("day_of_week"),
        F.col("avg_speed").cast("double").alias("avg_speed"),
        F.col("avg_delay_minutes").cast("double").alias("avg_delay_minutes"),
    ).distinct()


def _with_cutoff(rows: DataFrame, events: DataFrame, cutoff) -> DataFrame:
    """Attach the cutoff: a given time, or the one-row aggregate of ``events``.

    With a list of times every row counts for each of them that is not before it.
    """
    if isinstance(cutoff, (list, tuple)):
        times = F.array(*[F.lit(c).cast("timestamp_ntz") for c in cutoff])
        return rows.withColumn("source_cutoff", F.explode(F.filter(times, lambda c: c >= F.col("event_ts"))))
    if cutoff is not None:
        return rows.withColumn("source_cutoff", F.lit(cutoff).cast("timestamp_ntz"))
    latest = source_cutoff(events).where(F.col("source_cutoff").isNotNull())
    return rows.crossJoin(F.broadcast(latest))  # exactly one row


def daily_rollup(
    events: DataFrame,
    cutoff=None,
    baseline_days: int = BASELINE_DAYS,
    slot_days: int = SLOT_DAYS,
) -> DataFrame:
    """Sums and counts per route, hour, weekday and date.

    Every feature below is derived from this table, whose size is slots times
    days and cutoffs whatever the number of events. Duplicates go first, which
    shuffles the valid rows once, for any number of cutoffs; the sums after that
    are combined before their own shuffle. Without a given cutoff a second scan
    finds the latest event.
    """
    rows = _with_cutoff(distinct_events(events), events, cutoff)

    def since(days: int, c: str) -> Column:
        start = F.col("source_cutoff") - F.make_dt_interval(F.lit(days))
        return F.when(F.col("event_ts") >= start, F.col(c))

    speed, delay = "avg_speed", "avg_delay_minutes"
    measures = {
        "speed": F.col(speed),
        "delay": F.col(delay),
        "speed_base": since(baseline_days, speed),
        "speed_slot": since(slot_days, speed),
        "delay_slot": since(slot_days, delay),
    }
    return rows.groupBy(
        *SLOT_KEYS, "source_cutoff", F.to_date("event_ts").alias("day")
    ).agg(
        *[F.sum(c).alias(f"sum_{name}") for name, c in measures.items()],
        *[F.count(c).alias(f"n_{name}") for name, c in measures.items()],
    )


def _mean(name: str) -> Column:
    """Mean from the summed parts; null without values."""
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def baseline(daily: DataFrame) -> DataFrame:
    """Mean speed per route over the trailing baseline days."""
    return (
        daily.groupBy(*ROUTE_KEYS)
        .agg(_mean("speed_base").alias("baseline_speed_7d"), F.sum("n_speed_base").alias("_n"))
        .where(F.col("_n") > 0)
        .drop("_n")
    )


def slot_means(daily: DataFrame) -> DataFrame:
    """Mean speed and delay per slot over the trailing slot days."""
    return daily.groupBy(*SLOT_KEYS).agg(
        _mean("speed_slot").alias("avg_speed_hour_dow_4w"),
        _mean("delay_slot").alias("avg_delay_hour_dow_4w"),
    )


_DAY_BEFORE = ["sum_speed", "n_speed", "sum_delay", "n_delay"]


def _with_day_before(daily: DataFrame) -> DataFrame:
    """Add the totals of the same route and hour one calendar day earlier.

    The weekday of the earlier row is not compared. A value frame on the date
    replaces the self join; its partitions hold one row per day and weekday.
    """
    before = (
        Window.partitionBy(*ROUTE_KEYS, "hour", "source_cutoff")
        .orderBy(F.unix_date("day"))
        .rangeBetween(-1, -1)
    )
    return daily.withColumns({f"before_{c}": F.sum(c).over(before) for c in _DAY_BEFORE})


def _latest_day_before() -> list[Column]:
    totals = F.struct(*[F.col(f"before_{c}").alias(c) for c in _DAY_BEFORE])
    return [F.max("day").alias("latest_date"), F.max_by(totals, "day").alias("_before")]


def _before_means() -> dict[str, Column]:
    return {
        "avg_delay_same_hour_yesterday": F.try_divide("_before.sum_delay", "_before.n_delay"),
        "avg_speed_same_hour_yesterday": F.try_divide("_before.sum_speed", "_before.n_speed"),
    }


def latest_slot_dates(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*SLOT_KEYS).agg(F.max("day").alias("latest_date"))


def prev_day_same_hour(daily: DataFrame) -> DataFrame:
    """Means of the day before each slot's own latest date, same hour."""
    slots = _with_day_before(daily).groupBy(*SLOT_KEYS).agg(*_latest_day_before())
    return slots.withColumns(_before_means()).drop("_before")


def dense_slots(routes: DataFrame) -> DataFrame:
    """Every hour and weekday of every route."""
    hours = routes.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))))
    return hours.withColumn("day_of_week", F.explode(F.sequence(F.lit(0), F.lit(WEEKDAYS - 1))))


def longterm_features(
    events: DataFrame,
    cutoff=None,
    baseline_days: int = BASELINE_DAYS,
    slot_days: int = SLOT_DAYS,
    online: bool = False,
) -> DataFrame:
    """The dense feature table: 168 rows per route and cutoff.

    ``cutoff`` is a time, a list of times, or nothing for the latest event. With ``online``
    the rows have the route part of their online key, made once per route.
    The slots of a route (at most 168) are gathered into one map and expanded
    over the dense grid, so the grid needs no join.
    """
    daily = daily_rollup(events, cutoff, baseline_days, slot_days)
    slots = (
        _with_day_before(daily)
        .groupBy(*SLOT_KEYS, "source_cutoff")
        .agg(
            _mean("speed_slot").alias("avg_speed_hour_dow_4w"),
            _mean("delay_slot").alias("avg_delay_hour_dow_4w"),
            F.sum("sum_speed_base").alias("sum_speed_base"),
            F.sum("n_speed_base").alias("n_speed_base"),
            *_latest_day_before(),
        )
        .withColumns(_before_means())
    )
    per_slot = [c for c in LONGTERM_FEATURES if c != "baseline_speed_7d"]
    number = F.col("hour") * WEEKDAYS + F.col("day_of_week")
    entry = F.struct(number.alias("slot"), F.struct(*per_slot).alias("values"))
    routes = slots.groupBy(*ROUTE_KEYS, "source_cutoff").agg(
        _mean("speed_base").alias("baseline_speed_7d"),
        F.map_from_entries(F.collect_list(entry)).alias("_slots"),
    )
    if online:
        routes = routes.withColumn(ONLINE_ROUTE, online_route())
    grid = dense_slots(routes).withColumn("_values", F.try_element_at("_slots", number))
    return grid.select(
        *SLOT_KEYS,
        *([ONLINE_ROUTE] if online else []),
        "baseline_speed_7d",
        *[F.col(f"_values.{c}").alias(c) for c in per_slot],
        "source_cutoff",
        F.to_date("source_cutoff").alias("dt"),
        now_ntz().alias("updated_at"),
    )


def online_snapshot(
    features: DataFrame,
    carry_forward: bool = True,
    ttl_seconds: int = ONLINE_TTL_SECONDS,
    as_of=None,
    written_at: str = "source_cutoff",
    fields: Sequence[str] = tuple(LONGTERM_FEATURES),
) -> DataFrame:
    """State of the online store after all writes of ``features``, by key.

    A write sets only its non-null fields and renews the key's time to live, so
    an older value survives until a newer one arrives or the key lapses for
    ``ttl_seconds``. With ``carry_forward=False`` only the last write counts.
    Routes with equal slugs share a key; the last in the publish order wins. The slugs of a
    route are made for every row unless ``features`` has them (``longterm_features``).
    ``as_of`` (default: the last write of all) drops keys that lapsed by then.
    """
    parts = ["city", "district", "road_name"]
    when = F.col(written_at)
    key = online_slot(ONLINE_ROUTE) if ONLINE_ROUTE in features.columns else online_key()
    writes = features.select(
        key.alias("feature_key"),
        when.alias("_at"),
        F.struct(when, *parts).alias("_turn"),
        *fields,
        F.col("source_cutoff").alias("_source"),
    )
    of_key = Window.partitionBy("feature_key")
    gap = seconds_between(F.lag("_at").over(of_key.orderBy("_at")), "_at")
    marked = writes.withColumn("_born", F.when(gap >= ttl_seconds, F.col("_at")))
    # Everything before the last lapse of the key is gone.
    alive = marked.withColumn("_birth", F.max("_born").over(of_key)).where(
        F.col("_birth").isNull() | (F.col("_at") >= F.col("_birth"))
    )
    if not carry_forward:
        alive = alive.withColumn("_last", F.max("_at").over(of_key)).where("_at = _last")

    def newest(c: str) -> Column:
        pair = F.struct("_turn", F.col(c).alias("_value"))
        return F.max(F.when(F.col(c).isNotNull(), pair))["_value"]

    state = alive.groupBy("feature_key").agg(
        *[newest(c).alias(c) for c in fields],
        newest("_source").alias("source_cutoff"),
        F.max("_at").alias("written_at"),
    )
    if as_of is None:
        latest = features.agg(F.max(when).alias("_as_of"))
        state = state.crossJoin(F.broadcast(latest))  # exactly one row
    else:
        state = state.withColumn("_as_of", F.lit(as_of).cast("timestamp_ntz"))
    fresh = seconds_between("written_at", "_as_of") < ttl_seconds
    return state.where(fresh).drop("_as_of")
