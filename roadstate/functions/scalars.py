"""Scalar building blocks: Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from roadstate.functions.slugs import slug
from roadstate.schemas import ROUTE_KEYS

# Thresholds of the road status and severity rules.
CONGESTED_SPEED, CONGESTED_DELAY = 10, 10
SLOW_SPEED, SLOW_DELAY = 20, 5
HIGH_SEVERITY_SPEED = 7
HIGH_SEVERITY_ACCIDENTS = 2


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time ---------------------------------------------------------------------


def calendar(ts: Column | str) -> dict[str, Column]:
    """Hour, weekday (Monday is 0), weekend flag and peak-hour flag."""
    hour, dow = F.hour(_col(ts)), F.weekday(_col(ts))
    peak = hour.between(7, 9) | hour.between(16, 19)
    return {
        "hour": hour,
        "day_of_week": dow,
        "is_weekend": (dow >= 5).cast("int"),
        "is_peak_hour": peak.cast("int"),
    }


def parse_time(text: Column | str) -> Column:
    """ISO text to a zone-free timestamp; null when it does not parse."""
    return F.replace(_col(text), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def to_second(ts: Column) -> Column:
    return F.date_trunc("SECOND", ts).cast("timestamp_ntz")


def now_ntz() -> Column:
    return F.localtimestamp()


def best_effort_time(*texts: Column) -> Column:
    """First text that parses, at second resolution, else the current time."""
    return to_second(F.coalesce(*[parse_time(t) for t in texts], now_ntz()))


_MINUTE, _SECOND = T.DayTimeIntervalType(2, 2), T.DayTimeIntervalType(3, 3)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero.

    Interval arithmetic on zone-free times: no session zone takes part.
    """
    return (_col(end) - _col(start)).cast(_MINUTE).cast("bigint")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end``, with their fraction."""
    return (_col(end) - _col(start)).cast(_SECOND).cast("decimal(24,6)")


# -- rules --------------------------------------------------------------------


def road_status(accidents: Column | str, speed: Column | str, delay: Column | str) -> Column:
    """Ordered status rules; a null operand never matches."""
    accidents, speed, delay = _col(accidents), _col(speed), _col(delay)
    return (
        F.when(accidents >= 1, F.lit("ACCIDENT"))
        .when((speed < CONGESTED_SPEED) | (delay >= CONGESTED_DELAY), F.lit("CONGESTED"))
        .when((speed < SLOW_SPEED) | (delay >= SLOW_DELAY), F.lit("SLOW"))
        .otherwise(F.lit("NORMAL"))
    )


def severity(rule: str, value: Column | str) -> Column:
    """Alert severity for the ``congestion`` (speed) or ``accident`` (count) rule."""
    conditions = {
        "congestion": _col(value) < HIGH_SEVERITY_SPEED,
        "accident": _col(value) >= HIGH_SEVERITY_ACCIDENTS,
    }
    return F.when(conditions[rule], F.lit("high")).otherwise(F.lit("medium"))


# -- text and keys ------------------------------------------------------------


def blank_to(col: Column | str, value: str = "unknown") -> Column:
    """Null and empty text become ``value``."""
    return F.coalesce(F.nullif(_col(col), F.lit("")), F.lit(value))


def route_key(*cols: str) -> Column:
    """Text form of a series key; absent parts count as empty."""
    return F.concat_ws("|", *[F.coalesce(_col(c), F.lit("")) for c in cols or ROUTE_KEYS])


def online_route(road: str = "road_name", district: str = "district", city: str = "city") -> Column:
    """The part of an online key that belongs to the route."""
    return F.concat_ws(":", F.lit("traffic:longterm"), slug(city), slug(district), slug(road))


def online_slot(route: Column | str, hour: str = "hour", dow: str = "day_of_week") -> Column:
    """An online key from its route part; absent hour or weekday count as 0."""
    number = F.coalesce(_col(hour).cast("int"), F.lit(0))
    digits = F.when(number.between(0, 9), F.concat(F.lit("0"), number.cast("string"))).otherwise(number.cast("string"))
    weekday = F.coalesce(_col(dow).cast("int"), F.lit(0)).cast("string")
    return F.concat(_col(route), F.lit(":h"), digits, F.lit(":dow"), weekday)


def online_key(
    road: str = "road_name",
    district: str = "district",
    city: str = "city",
    hour: str = "hour",
    dow: str = "day_of_week",
) -> Column:
    """Key of the online feature store; absent hour or weekday count as 0."""
    return online_slot(online_route(road, district, city), hour, dow)


# -- JSON ---------------------------------------------------------------------
# The document is parsed once into the wanted fields, each kept as a VARIANT. The
# extractors then honour the JSON type, as the typed JSON readers of analytic
# stores do: a number is not a string, a quoted number is not a number, and 2.0
# is not an integer.


def json_doc(raw: Column | str, *names: str, **nested: Sequence[str]) -> Column:
    """Struct of the named fields; ``nested`` lists the fields of inner objects."""
    fields = [T.StructField(n, T.VariantType()) for n in names]
    for name, inner in nested.items():
        fields.append(T.StructField(name, T.StructType([T.StructField(n, T.VariantType()) for n in inner])))
    return F.from_json(_col(raw), T.StructType(fields))


def json_text(value: Column) -> Column:
    """A non-blank JSON string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.nullif(value.cast("string"), F.lit("")))


def first_json(*values: Column, default: str | None = None) -> Column:
    """First non-blank string among ``values``, else ``default``."""
    return F.coalesce(*[json_text(v) for v in values], F.lit(default))


def json_double(value: Column) -> Column:
    numeric = F.schema_of_variant(value).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(numeric, value.cast("double"))


def json_long(value: Column, default: int | None = None) -> Column:
    whole = F.when(F.schema_of_variant(value) == "BIGINT", value.cast("bigint"))
    return whole if default is None else F.coalesce(whole, F.lit(default).cast("bigint"))


def json_int(value: Column, default: int | None = None) -> Column:
    return json_long(value, default).try_cast("int")
