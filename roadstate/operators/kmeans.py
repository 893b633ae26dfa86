"""KMeans of many seeds in shared passes over all rows.

Restarts differ in their centres only, so one pass serves them all: a task holds its rows
as packed blocks, a matrix product gives the distances to the centres of every restart,
and a grouped sum adds up what the tasks have found. The number of passes is that of one
fit, and what leaves a task is a row per centre, whatever the number of rows.

What a task holds at once is bounded, too. Spark keeps blocks through a Java stream that
holds up to 100 of its batches (some 4 MB each), so ``spread`` bounds the rows of a
partition; and an Arrow batch has up to 10,000 blocks, so a block is small.

Seeding is k-means++ over all rows: the next centre of a restart is a row drawn with its
squared distance from the centres so far as weight. The least of exponential draws divided
by the weights is such a row, so tasks draw on their own and the smallest draw wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, functions as F

# Fixed values of a fit: passes that move centres, and the move that ends them.
MAX_ITERATIONS, TOLERANCE = 20, 1e-4
#: Rows whose distances to all centres a task holds at once.
AT_ONCE = 4096
#: Bytes of a block, if it has more than one row, and of the rows of a partition.
BLOCK_BYTES, PARTITION_BYTES = 1 << 10, 1 << 26


@dataclass(frozen=True)
class Fit:
    """The centres with the least sum of squared distances, and the rows of each."""

    centres: np.ndarray
    cost: float
    sizes: list[int]


def spread(points: DataFrame, width: int, rows: int, largest: int) -> DataFrame:
    """``rows`` points over all slots, none of them with more than PARTITION_BYTES.

    ``largest`` is the number of rows of the largest partition so far. Splits of one file
    can leave all rows to one of them, so the number of partitions does not tell.
    """
    slots = points.sparkSession.sparkContext.defaultParallelism
    most = max(1, PARTITION_BYTES // (8 * width))
    if largest <= most and points.rdd.getNumPartitions() >= slots:
        return points
    return points.repartition(max(slots, -(-rows // most)))


def packed(points: DataFrame) -> DataFrame:
    """Arrays of doubles as blocks of rows, which the passes read without looking at rows."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in incoming:
            if b.num_rows:
                values = b.column(0).flatten().to_numpy(zero_copy_only=False)
                if np.isnan(values).any():
                    raise ValueError("a feature is not a number")
                row = values.nbytes // b.num_rows
                step = max(1, BLOCK_BYTES // row) * row
                ends = np.minimum(np.arange(0, values.nbytes + step, step), values.nbytes).astype(np.int32)
                buffers = [None, pa.py_buffer(ends), pa.py_buffer(values)]
                yield pa.record_batch([pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)], ["block"])

    return points.mapInArrow(run, "block binary").persist(StorageLevel.MEMORY_AND_DISK)


def _parts(incoming: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for b in incoming:
        blocks = b.column(0).cast(pa.binary())
        if len(blocks):
            # The bytes of all blocks of a batch stand in a row.
            _, ends, values = blocks.buffers()
            ends = np.frombuffer(ends, np.int32)[blocks.offset : blocks.offset + len(blocks) + 1]
            rows = np.frombuffer(values, float, (ends[-1] - ends[0]) // 8, ends[0]).reshape(-1, width)
            for at in range(0, len(rows), AT_ONCE):
                yield rows[at : at + AT_ONCE]


def _half_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Half the squared distances without the term of the row: (row, restart, centre)."""
    flat = centres.reshape(-1, centres.shape[2])
    return (0.5 * np.square(flat).sum(1) - rows @ flat.T).reshape(len(rows), *centres.shape[:2])


def _draw(blocks: DataFrame, centres: np.ndarray, seeds: Sequence[int], width: int) -> np.ndarray:
    """The next centre of every restart: a row drawn by its squared distance."""
    number = centres.shape[1]

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        draws = [np.random.default_rng((abs(s), number, task)) for s in seeds]
        least, found = np.full(len(seeds), np.inf), [None] * len(seeds)
        for rows in _parts(incoming, width):
            if number:
                near = _half_distances(rows, centres).min(2)
                weights = np.maximum(np.square(rows).sum(1)[:, None] + 2 * near, 0)
            else:
                weights = np.ones((len(rows), len(seeds)))
            for i, rng in enumerate(draws):
                with np.errstate(divide="ignore"):
                    keys = rng.exponential(size=len(rows)) / weights[:, i]
                at = int(keys.argmin())
                if found[i] is None or keys[at] < least[i]:
                    least[i], found[i] = keys[at], rows[at].copy()
        have = [i for i, f in enumerate(found) if f is not None]
        yield pa.record_batch(
            [pa.array(have, pa.int32()), pa.array(least[have]), pa.array([found[i] for i in have], pa.list_(pa.float64()))],
            ["restart", "draw", "point"],
        )

    drawn = blocks.mapInArrow(run, "restart int, draw double, point array<double>")
    first = F.min(F.struct("draw", "point"))["point"].alias("point")
    rows = drawn.groupBy("restart").agg(first).orderBy("restart").collect()  # one row per restart
    return np.array([r["point"] for r in rows])[:, None, :]


def _sums(blocks: DataFrame, centres: np.ndarray, width: int, add: Callable, columns: int) -> np.ndarray:
    """Sums of ``columns`` numbers per centre of every restart, over all rows."""
    count = centres.shape[0] * centres.shape[1]

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, columns))
        for rows in _parts(incoming, width):
            add(total, rows, _half_distances(rows, centres).argmin(2))
        yield pa.record_batch([pa.array(np.arange(count, dtype=np.int32)), pa.array(list(total))], ["at", "sums"])

    parts = blocks.mapInArrow(run, "at int, sums array<double>")
    each = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(columns)]
    found = parts.groupBy("at").agg(*each).orderBy("at").collect()  # one row per centre
    return np.array([r[1:] for r in found]).reshape(*centres.shape[:2], columns)


def _move(centres: np.ndarray) -> Callable:
    """Adds up the rows of every centre, and their number."""
    restarts, k, width = centres.shape

    def add(total: np.ndarray, rows: np.ndarray, nearest: np.ndarray) -> None:
        own = np.zeros((len(rows), restarts * k))
        own[np.arange(len(rows))[:, None], nearest + k * np.arange(restarts)] = 1
        total[:, :width] += own.T @ rows
        total[:, width] += own.sum(0)

    return add


def _cost(centres: np.ndarray) -> Callable:
    """Adds up the squared distances of the rows of every centre, by differences, and their number."""
    restarts, k, _ = centres.shape

    def add(total: np.ndarray, rows: np.ndarray, nearest: np.ndarray) -> None:
        for i in range(restarts):
            squares = np.square(rows - centres[i, nearest[:, i]]).sum(1)
            total[i * k : (i + 1) * k, 0] += np.bincount(nearest[:, i], squares, k)
            total[i * k : (i + 1) * k, 1] += np.bincount(nearest[:, i], minlength=k)

    return add


def fit(blocks: DataFrame, width: int, k: int, seeds: Sequence[int]) -> Fit:
    """The best of one fit per seed; ``blocks`` come from ``packed``.

    A centre that no row is nearest to stays where it is. With fewer different rows than
    ``k`` there are as many centres as different rows.
    """
    centres = np.empty((len(seeds), 0, width))
    for _ in range(k):
        centres = np.concatenate([centres, _draw(blocks, centres, seeds, width)], axis=1)
    for _ in range(MAX_ITERATIONS):
        found = _sums(blocks, centres, width, _move(centres), width + 1)
        n = found[..., width:]
        moved = np.where(n > 0, found[..., :width] / np.maximum(n, 1), centres)
        shift = np.square(moved - centres).sum(2).max()
        centres = moved
        if shift <= TOLERANCE * TOLERANCE:
            break
    found = _sums(blocks, centres, width, _cost(centres), 2)
    best = int(found[..., 0].sum(1).argmin())
    # Equal rows are all nearest to the first of equal centres.
    _, first = np.unique(centres[best], axis=0, return_index=True)
    keep = np.sort(first)
    return Fit(centres[best, keep], float(found[best, :, 0].sum()), [int(n) for n in found[best, keep, 1]])


def assigned(blocks: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every row as ``point`` with the number of its nearest centre as ``prediction``."""
    width = centres.shape[1]

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(incoming, width):
            offsets = pa.array(np.arange(0, rows.size + 1, width, dtype=np.int32))
            points = pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))
            nearest = _half_distances(rows, centres[None])[:, 0].argmin(1).astype(np.int32)
            yield pa.record_batch([points, pa.array(nearest)], ["point", "prediction"])

    return blocks.mapInArrow(run, "point array<double>, prediction int")
