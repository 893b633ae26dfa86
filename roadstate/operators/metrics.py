"""Euclidean silhouette without pairs of rows.

The silhouette of a row needs its mean distance to every cluster. For a bounded set of
rows these are sums over ALL rows, which every task adds up for what it has read: one
pass, a fixed number of sums per task, no pair leaves a task. Equal points of a cluster
count once with their number. While the different points are at most ``sample``, all of
them are taken and the mean is exact; beyond that about ``sample`` rows are drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 2000
#: The error bound holds with this probability.
CONFIDENCE = 0.99
#: Rows whose distances to all taken points a task holds at once.
AT_ONCE = 256
#: Squared distance, as a share of the squared distances from the origin, below which a pair is close.
CLOSE = 1e-6


def silhouette(
    rows: DataFrame, point: str = "point", cluster: str = "prediction", sample: int = SAMPLE, seed: int = 7
) -> tuple[float, float]:
    """Mean silhouette over all rows and its error bound (0 when it is exact).

    ``point`` is an array of doubles. Rows alone in their cluster count as 0, as do all
    rows when there is one cluster. By Hoeffding's inequality the mean of m values
    between -1 and 1 is within sqrt(2 ln(2 / (1 - confidence)) / m) of the true one.
    """
    points = rows.groupBy(F.col(point).alias("point"), F.col(cluster).cast("int").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n")
    ).persist()
    try:
        sizes = {r["cluster"]: r["n"] for r in points.groupBy("cluster").agg(F.sum("n").alias("n")).collect()}
        total, different = sum(sizes.values()), points.count()
        if len(sizes) < 2:
            return 0.0, 0.0
        exact = different <= sample
        if exact:
            taken = points.collect()
        else:
            drawn = rows.select(F.col(point).alias("point"), F.col(cluster).cast("int").alias("cluster"), F.lit(1).alias("n"))
            taken = drawn.sample(min(1.0, sample / total), seed=seed).collect()
            if not taken:
                return 0.0, 1.0
        # Clusters by number, so that the sums of a point stand in a row.
        names = sorted(sizes)
        place = {c: i for i, c in enumerate(names)}
        sums = _distance_sums(points, np.array([r["point"] for r in taken]), place)
        counts = np.array([sizes[c] for c in names], float)
        own = np.array([place[r["cluster"]] for r in taken])
        each = np.arange(len(taken))
        weight = np.array([r["n"] for r in taken], float)
        within = sums[each, own] / np.maximum(counts[own] - 1, 1)
        means = sums / counts
        means[each, own] = np.inf
        nearest = means.min(1)
        larger = np.maximum(within, nearest)
        value = np.where((counts[own] > 1) & (larger > 0), (nearest - within) / np.where(larger > 0, larger, 1), 0.0)
        error = 0.0 if exact else math.sqrt(2 * math.log(2 / (1 - CONFIDENCE)) / len(taken))
        return float((value * weight).sum() / weight.sum()), error
    finally:
        points.unpersist()


def squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Between all rows of both, by a matrix product.

    A product loses digits where rows are close for their distance from the origin. The
    origin is put in the middle of ``left``; pairs that are still close for it are taken
    by differences, so that at most about six of sixteen digits are lost.
    """
    middle = left.mean(0)
    a, b = left - middle, right - middle
    norms = np.square(a).sum(1)[:, None] + np.square(b).sum(1)
    squares = a @ b.T
    squares *= -2
    squares += norms
    norms *= CLOSE
    at = np.flatnonzero(squares < norms)
    for start in range(0, len(at), 1 << 16):
        i, j = np.divmod(at[start : start + (1 << 16)], len(right))
        squares[i, j] = np.square(left[i] - right[j]).sum(1)
    return squares


def _distance_sums(points: DataFrame, taken: np.ndarray, place: dict[int, int]) -> np.ndarray:
    """Sum of the distances from every taken point to the rows of each cluster."""
    sent = points.sparkSession.sparkContext.broadcast((taken, place))
    schema = pa.schema([("at", pa.int32()), ("sums", pa.list_(pa.float64()))])

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, numbers = sent.value
        sums = np.zeros((len(centres), len(numbers)))
        for b in incoming:
            rows = np.array(b.column(0).to_pylist(), float)
            columns = np.array([numbers[c] for c in b.column(1).to_pylist()], int)
            weights = b.column(2).to_numpy().astype(float)
            for at in range(0, len(rows), AT_ONCE):
                here = slice(at, at + AT_ONCE)
                squares = squared_distances(centres, rows[here])
                spread = np.zeros((len(columns[here]), len(numbers)))
                spread[np.arange(len(spread)), columns[here]] = weights[here]
                sums += np.sqrt(squares, out=squares) @ spread
        yield pa.record_batch([pa.array(np.arange(len(centres), dtype=np.int32)), pa.array(list(sums))], schema=schema)

    parts = points.select("point", "cluster", "n").mapInArrow(run, "at int, sums array<double>")
    each = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(len(place))]
    found = parts.groupBy("at").agg(*each).collect()  # one row per taken point
    out = np.zeros((len(taken), len(place)))
    for r in found:
        out[r["at"]] = [r[f"s{i}"] for i in range(len(place))]
    sent.unpersist()
    return out
