"""Hard negatives of anchor vectors by bounds along a spanning tree of the anchors.

Anchors of a block are joined into a minimum spanning tree by distance. A candidate's
score with the root is computed; down an edge it changes by at most the edge's length
times the candidate's norm (Cauchy-Schwarz on the difference of the two anchors), so a
parent's score, or its bounds, bound every child's. Only a candidate whose bounds meet
an anchor's window is rescored, exactly, in integers; its score then bounds the subtree.

Two walks per block: the first finds each anchor's best rows of its own label (window:
at least the worst entry so far), the second the best rows of other labels in the
window under each positive. Starting windows come from the block's own anchors, which
are rows like all others; every task raises them by what it finds and hands on its few
best, so nothing grows with the candidates but the walk itself. Vectors that are
copies of each other, however many, are cut by rows like any others.

Defined results: a row with a null label or vector or a null component takes no part.
Vectors of several sizes count as padded with zeros. Equal scores rank by id, null ids
last; a null id is never an anchor. Rows with the anchor's own id are neither positives
nor negatives of it. Each row stands for itself when its id repeats. Empty tables give
no rows; other columns are not looked at. Scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstate.llm.common import batch, written
from roadstate.session import work_dir

#: Candidates that walk down the tree together.
CHUNK = 2048
NO_ID = np.iinfo(np.int64).max


@dataclass
class Anchors:
    """A block of anchors in the order of its spanning tree (a parent before its children)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parents: np.ndarray
    edges: np.ndarray
    largest: int = 0
    #: Per anchor the (id, score) of its positives; filled after the first walk.
    positives: list[list[tuple[int | None, int]]] = field(default_factory=list)


def spanning_tree(vectors: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """Prim's tree over the rows: order of visit, parent (as a place in that order), edge length."""
    n = len(vectors)
    near, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    left = np.ones(n, bool)
    order, parents, edges, place, at = [0], [-1], [0.0], {0: 0}, 0
    left[0] = False
    for _ in range(n - 1):
        gap = np.sqrt(np.square(vectors - vectors[at]).sum(1))
        closer = left & (gap < near)
        near[closer], parent[closer] = gap[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))
        left[at] = False
        place[at] = len(order)
        order.append(at)
        parents.append(place[int(parent[at])])
        edges.append(float(near[at]))
    return order, parents, edges


def anchors_of(rows: list[tuple], size: int) -> Anchors:
    vectors = padded([r[2] for r in rows], size)
    order, parents, edges = spanning_tree(vectors.astype(np.float64))
    ids = np.array([rows[i][0] for i in order], np.int64)
    labels = np.array([rows[i][1] for i in order], np.int64)
    largest = max((abs(int(v)) for v in (vectors.min(initial=0), vectors.max(initial=0))), default=0)
    return Anchors(ids, labels, vectors[order], np.array(parents), np.array(edges), largest)


def padded(vectors: list, size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


class Candidates:
    """Some rows of the table: ids (a null as the largest), labels, vectors, norms."""

    def __init__(self, b: pa.RecordBatch, size: int) -> None:
        self.ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.null = b.column(0).is_null().to_numpy(zero_copy_only=False)
        self.labels = b.column(1).to_numpy()
        lists = b.column(2)
        flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        if len(lists) and (np.diff(offsets) == size).all():
            self.vectors = flat[offsets[0] : offsets[-1]].reshape(len(lists), size)
        else:
            self.vectors = padded([flat[a:z] for a, z in zip(offsets, offsets[1:])], size)
        self.floats = self.vectors.astype(np.float64)
        self.norms = np.sqrt(np.square(self.floats).sum(1))
        self.largest = max((abs(int(v)) for v in (self.vectors.min(initial=0), self.vectors.max(initial=0))), default=0)

    def scores(self, anchors: Anchors, a: int, rows: np.ndarray | slice) -> np.ndarray:
        """Exact inner products: in doubles while every partial sum fits their 53 bits."""
        if anchors.largest * self.largest * max(1, self.vectors.shape[1]) < 1 << 52:
            return (self.floats[rows] @ anchors.vectors[a].astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchors.vectors[a]


def walk(c: Candidates, anchors: Anchors, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, exact scores) of the candidates whose bounds `wanted(anchor, low, high)` takes."""
    lows, highs = [], []
    for a, (p, edge) in enumerate(zip(anchors.parents, anchors.edges, strict=True)):
        if p < 0:
            scores = c.scores(anchors, a, slice(None))
            low = high = scores.astype(np.float64)
            rows = np.flatnonzero(wanted(a, low, high))
            scores = scores[rows]
        else:
            slack = edge * c.norms * (1 + 1e-9) + 1e-3
            low, high = lows[p] - slack, highs[p] + slack
            rows = np.flatnonzero(wanted(a, low, high))
            if len(rows):
                scores = c.scores(anchors, a, rows)
                low[rows] = high[rows] = scores
        lows.append(low)
        highs.append(high)
        if len(rows):
            yield a, rows, scores


class Best:
    """The first `k` (score, id) entries of one list; higher scores first, then smaller ids."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = self.ids = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, null = np.concatenate([self.ids, ids]), np.concatenate([self.null, null])
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]

    def worst(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def rows(self) -> list[tuple[int | None, int]]:
        entries = zip(self.scores.tolist(), self.ids.tolist(), self.null.tolist(), strict=True)
        return [(None if missing else i, s) for s, i, missing in entries]


class Positives:
    """Best rows of each anchor's own label."""

    def __init__(self, anchors: Anchors, k: int) -> None:
        self.anchors = anchors
        self.best = [Best(k) for _ in anchors.ids]
        self.least: list[float] = [-np.inf] * len(anchors.ids)

    def start(self, least: list[float]) -> None:
        self.least = list(least)

    def add(self, c: Candidates) -> None:
        def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            ours = (c.labels == self.anchors.labels[a]) & ((c.ids != self.anchors.ids[a]) | c.null)
            return ours & (high >= self.least[a])

        for a, rows, scores in walk(c, self.anchors, wanted):
            ok = scores >= self.least[a]
            rows, scores = rows[ok], scores[ok]
            if len(rows):
                self.best[a].add(scores, c.ids[rows], c.null[rows])
                worst = self.best[a].worst()
                if worst is not None:
                    self.least[a] = max(self.least[a], worst)

    def rows(self) -> Iterator[tuple]:
        for a, best in enumerate(self.best):
            for row_id, score in best.rows():
                yield a, 0, row_id, score


class Negatives:
    """Best rows of other labels in the window under each positive."""

    def __init__(self, anchors: Anchors, k: int, low: int, high: int) -> None:
        self.anchors, self.share = anchors, (low, high)
        self.best = [[Best(k) for _ in p] for p in anchors.positives]
        # The window's lower end in whole scores: the least s with low * p <= high * s.
        self.least = [[-((-low * s) // high) for _, s in p] for p in anchors.positives]

    def start(self, least: list[list[int]]) -> None:
        self.least = [[max(x, y) for x, y in zip(mine, given, strict=True)] for mine, given in zip(self.least, least, strict=True)]

    def add(self, c: Candidates) -> None:
        def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            hit = np.zeros(len(low), bool)
            for (_, most), least in zip(self.anchors.positives[a], self.least[a], strict=True):
                if least <= most:
                    hit |= (high >= least) & (low <= most)
            return hit & (c.labels != self.anchors.labels[a]) & ((c.ids != self.anchors.ids[a]) | c.null)

        for a, rows, scores in walk(c, self.anchors, wanted):
            for i, (_, most) in enumerate(self.anchors.positives[a]):
                ok = (scores >= self.least[a][i]) & (scores <= most)
                if ok.any():
                    best = self.best[a][i]
                    best.add(scores[ok], c.ids[rows[ok]], c.null[rows[ok]])
                    worst = best.worst()
                    if worst is not None:
                        self.least[a][i] = max(self.least[a][i], worst)

    def rows(self) -> Iterator[tuple]:
        for a, lists in enumerate(self.best):
            for i, best in enumerate(lists):
                for row_id, score in best.rows():
                    yield a, i, row_id, score


HIT = pa.schema([("anchor", pa.int64()), ("place", pa.int64()), ("row_id", pa.int64()), ("score", pa.int64())])


def walked(vectors: DataFrame, anchors: Broadcast, size: int, collector, least: list) -> DataFrame:
    """anchor, place, row_id, score: every task's best rows."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = collector(anchors.value)
        found.start(least)
        for b in incoming:
            for at in range(0, b.num_rows, CHUNK):
                found.add(Candidates(b.slice(at, CHUNK), size))
        rows = list(found.rows())
        for at in range(0, len(rows), 4096):
            yield batch(rows[at : at + 4096], HIT)

    return vectors.mapInArrow(run, "anchor long, place long, row_id long, score long")


def first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("row_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def of_rows(anchors: Anchors) -> Candidates:
    """The anchors as candidates, for the windows to start from."""
    flat = pa.array(anchors.vectors.reshape(-1))
    n, size = anchors.vectors.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), flat)
    columns = [pa.array(anchors.ids), pa.array(anchors.labels), lists]
    return Candidates(pa.record_batch(columns, ["row_id", "label", "vector"]), size)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block: int = 2048,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has integer vectors; `is_anchor` is a condition on its columns. For each
    anchor and each of its best `positives` rows of equal label with score p, the first
    `negatives` rows of another label with low * p <= high * score <= high * p.
    `block` anchors make one tree and one pair of passes over the rows.
    """
    spark = rows.sparkSession
    known = F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(vector_col, lambda x: x.isNull())
    vectors = written(
        rows.where(known).select(
            F.col(id_col).cast("long").alias("row_id"),
            F.col(label_col).cast("long").alias("label"),
            F.col(vector_col).cast("array<long>").alias("vector"),
            (F.col(id_col).isNotNull() & F.coalesce(is_anchor, F.lit(False))).alias("anchor"),
        ),
        "negatives-vectors",
    )
    size = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    out = work_dir(spark, "negatives")
    # Anchors of a label stand together, so that a block's tree has short edges.
    chosen = vectors.where("anchor").select("row_id", "label", "vector").orderBy("label", "row_id")
    narrow = vectors.select("row_id", "label", "vector")
    chunk: list[tuple] = []

    def mine(anchors: Anchors) -> None:
        own = of_rows(anchors)
        seeds = Positives(anchors, positives)
        seeds.add(own)
        sent = spark.sparkContext.broadcast(anchors)
        found = first(walked(narrow, sent, size, lambda a: Positives(a, positives), seeds.least), positives)
        anchors.positives = [[] for _ in anchors.ids]
        for a, row_id, score in found.orderBy("anchor", "rank").select("anchor", "row_id", "score").collect():
            anchors.positives[a].append((row_id, score))  # `positives` per anchor at most
        sent.unpersist()

        begin = Negatives(anchors, negatives, low, high)
        begin.add(own)
        sent = spark.sparkContext.broadcast(anchors)
        hits = walked(narrow, sent, size, lambda a: Negatives(a, negatives, low, high), begin.least)
        names = [
            (a, i, int(anchors.ids[a]), row_id, score)
            for a, own_list in enumerate(anchors.positives)
            for i, (row_id, score) in enumerate(own_list)
        ]
        named = spark.createDataFrame(
            names, "anchor long, place long, anchor_id long, positive_id long, positive_score long"
        )
        first(hits, negatives).join(F.broadcast(named), ["anchor", "place"]).select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("row_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
        sent.unpersist()

    for row in chosen.toLocalIterator():
        chunk.append(tuple(row))
        if len(chunk) == block:
            mine(anchors_of(chunk, size))
            chunk = []
    if chunk:
        mine(anchors_of(chunk, size))
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    spark.createDataFrame([], schema).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)
