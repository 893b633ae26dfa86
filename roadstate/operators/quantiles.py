"""Exact medians of many columns without gathering any of them.

Spark's exact ``median`` keeps every distinct value of a column in one task. Here the
wanted ranks are found by descent: the range of values a rank lies in is cut into a
fixed number of buckets, one grouped count tells which bucket holds it, and that
bucket's own least and greatest value are the next range. A descent ends when a bucket
holds one value. All columns share each pass, and a pass groups into at most ``buckets``
entries per wanted rank, whatever the size of the data.

Buckets are of equal width, which suits most data and is plain arithmetic. Where that
does not spread the values (many magnitudes, infinities), the cuts are equally spaced in
the order-preserving bit pattern of doubles instead: each such pass fixes as many of the
64 bits as a bucket number has, so their number is bounded for any data.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 256


def _bits(x: float) -> int:
    """An integer that orders like the double."""
    (n,) = struct.unpack("<q", struct.pack("<d", x + 0.0))
    return n if n >= 0 else -(n & 0x7FFFFFFFFFFFFFFF)


def _double(bits: int) -> float:
    sign = 0 if bits >= 0 else 1 << 63
    return struct.unpack("<d", struct.pack("<Q", sign | abs(bits)))[0]


@dataclass(frozen=True)
class _Range:
    """Ranks (0-based) of a column that lie among the values from low to high."""

    column: str
    ranks: tuple[int, ...]
    before: int
    count: int
    low: float
    high: float
    by_bits: bool = False

    def bucket(self, buckets: int) -> Column:
        """Number of the bucket of a value in the range; larger values never get smaller numbers."""
        c, width = F.col(self.column), self.high - self.low
        if not self.by_bits and math.isfinite(width) and width > 0 and math.isfinite(buckets / width):
            number = F.floor((c - F.lit(self.low)) * F.lit(buckets / width)).cast("int")
            return F.least(number, F.lit(buckets - 1))
        low, high = _bits(self.low), _bits(self.high)
        cuts = sorted({low + (high - low) * i // buckets for i in range(1, buckets)} - {low})
        if not cuts:
            cuts = [high]
        points = F.array(*[F.lit(_double(b)) for b in cuts])
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

        def step(at: Column, size: Column) -> Column:
            return F.when(F.get(points, at + size - 1) <= c, at + size).otherwise(at)

        return F.aggregate(steps, F.lit(0), step)

    def inside(self) -> Column:
        return F.col(self.column).between(F.lit(self.low), F.lit(self.high))

    def narrow(self, found: Sequence, buckets: int) -> list[_Range]:
        """The buckets that hold the ranks, from (number, count, least, greatest) rows."""
        parts, before, left = [], self.before, list(self.ranks)
        for row in sorted(found, key=lambda r: r["bucket"]):
            mine = tuple(r for r in left if r < before + row["n"])
            if mine:
                left = left[len(mine) :]
                # A bucket that keeps most of the rows: equal widths do not spread them.
                poor = self.by_bits or row["n"] > self.count / 2
                parts.append(_Range(self.column, mine, before, row["n"], row["low"], row["high"], poor))
            before += row["n"]
        return parts


def exact_medians(
    df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, stored: bool = False
) -> dict[str, float | None]:
    """Median of each numeric column (mean of the two middle values).

    Null and NaN are missing; a column without values gives None. Rows of a ``stored``
    table are read by every pass, of others the wanted columns are kept.
    """
    def number(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value + F.lit(0.0)).alias(c)

    data = df.select(*map(number, columns))
    if stored:
        return _medians(data, columns, buckets)
    # Every pass reads the same narrow rows; what they come from is computed once.
    data.persist()
    try:
        return _medians(data, columns, buckets)
    finally:
        data.unpersist()


def _medians(data: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, float | None]:
    facts = [f(c).alias(f"{c}|{name}") for c in columns for name, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    first = data.agg(*facts).first()
    values: dict[str, dict[int, float]] = {c: {} for c in columns}
    sizes = {c: first[f"{c}|n"] for c in columns}
    ranges = [
        _Range(c, tuple(sorted({(n - 1) // 2, n // 2})), 0, n, first[f"{c}|low"], first[f"{c}|high"])
        for c, n in sizes.items()
        if n
    ]
    while True:
        for r in ranges:
            if r.low == r.high:
                values[r.column] |= dict.fromkeys(r.ranks, r.low)
        ranges = [r for r in ranges if r.low != r.high]
        if not ranges:
            break
        entries = [
            F.when(
                r.inside(),
                F.struct(F.lit(i).alias("range"), r.bucket(buckets).alias("bucket"), F.col(r.column).alias("value")),
            )
            for i, r in enumerate(ranges)
        ]
        placed = data.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
        counted = placed.groupBy("range", "bucket").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        found: dict[int, list] = {}
        for row in counted.collect():  # at most ``buckets`` rows per range
            found.setdefault(row["range"], []).append(row)
        ranges = [part for i, r in enumerate(ranges) for part in r.narrow(found[i], buckets)]
    medians: dict[str, float | None] = dict.fromkeys(columns)
    for c, n in sizes.items():
        if n:
            low, high = values[c][(n - 1) // 2], values[c][n // 2]
            medians[c] = low if low == high else (low + high) / 2
    return medians
