"""Ranked lexical search: the best documents of every query item, LEMP style.

A document is a sparse vector of term impacts, an item one of term weights, the score
their inner product. Vectors are ordered by length and walked in buckets of neighbours:

* Cauchy-Schwarz drops a whole bucket for an item when the item's length times the
  longest vector of the bucket stays below the score that the item's list asks for;
* inside a bucket, an item's heaviest terms are its focus: as many as it takes for the
  rest of the item, times the bucket's length, to stay below that score. A document
  without a focus term is out; one with some is bounded by its focus part plus the
  product of the two rest lengths;
* survivors are rescored exactly, in 64-bit integers.

Only terms that some item has can add to a score, so vectors hold those terms; counts
and lengths of documents are taken over whole texts. Items go in blocks of bounded
size, each block one pass over the documents.

Defined results: a null or empty text has no terms, so it is neither counted nor
ranked, and an item without terms gets no rows. Each row of `docs` and each row of
`items` stands for itself, also when its id repeats; equal scores rank by id, null ids
last. Empty tables give no rows. Other columns are not looked at. A term longer than 64
bytes is known by its 128-bit hash.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstate.llm.common import batch, text_or_empty, written
from roadstate.session import work_dir

#: Every byte that is no part of a term becomes a blank; A-Z become a-z.
LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
FOLD = bytes(
    b if b >= 0x80 or b in LETTERS else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
LONG_TERM = 64
BUCKET = 8192


def term_key(term: bytes) -> bytes:
    return term if len(term) <= LONG_TERM else b"\0" + hashlib.blake2b(term, digest_size=16).digest()


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a whole text in order, with repeats."""
    terms = (text or "").encode("utf-8", "replace").translate(FOLD).split()
    if terms and max(map(len, terms)) > LONG_TERM:
        return [term_key(t) for t in terms]
    return terms


@dataclass
class Block:
    """Items of one pass: id, terms by index and their counts, and the block's vocabulary."""

    ids: list[int | None]
    terms: list[np.ndarray]
    counts: list[np.ndarray]
    vocabulary: dict[bytes, int]


ITEM = pa.schema([("row_id", pa.int64()), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def blocks(items: DataFrame, id_col: str, text_col: str, entries: int) -> Iterator[Block]:
    """Items in blocks of at most `entries` (item, term) pairs, one block at a time on the driver.

    A single item with more distinct terms than that is a block of its own.
    """

    def distinct(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in incoming:
            for row_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = Counter(terms_of(text.as_py()))
                if found:
                    yield batch([(row_id, list(found), list(found.values()))], ITEM)

    rows = items.select(F.col(id_col).cast("long").alias("row_id"), text_or_empty(text_col).alias("text"))
    found = written(rows.mapInArrow(distinct, "row_id long, terms array<binary>, counts array<long>"), "search-items")
    block, size = Block([], [], [], {}), 0
    for row in found.toLocalIterator():
        if block.ids and size + len(row.terms) > entries:
            yield block
            block, size = Block([], [], [], {}), 0
        vocabulary = block.vocabulary
        block.ids.append(row.row_id)
        block.terms.append(np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in row.terms], np.int64))
        block.counts.append(np.array(row.counts, np.int64))
        size += len(row.terms)
    if block.ids:
        yield block


def lists(values: np.ndarray, lengths: list[int]) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def term_counts(docs: DataFrame, vocabulary: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """row_id, n (terms with repeats), terms and tfs (of the vocabulary), per document with a term."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.get
        for b in incoming:
            ids, sizes, lengths, terms, tfs = [], [], [], [], []
            for row_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found = Counter(map(known, words))
                found.pop(None, None)
                ids.append(row_id)
                sizes.append(len(words))
                lengths.append(len(found))
                terms += found.keys()
                tfs += found.values()
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    lists(np.array(terms, np.int32), lengths),
                    lists(np.array(tfs, np.int32), lengths),
                ],
                ["row_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("row_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "row_id long, n long, terms array<int>, tfs array<int>")


def impacts(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """row_id, terms, values (integer impacts) and length of the vector, longest first in every partition.

    Ranges of length, and of id where lengths are equal, so copies spread over tasks.
    """
    m = F.expr(f"25 + ((75 * n * {n_docs}L) div {n_terms}L)")
    value = "transform(tfs, x -> (1000000000L * x) div (1000L * x + 8 * m))"
    length = "sqrt(aggregate(values, 0D, (a, x) -> a + double(x) * double(x)))"
    vectors = counted.where(F.size("terms") > 0).withColumn("m", m).withColumn("values", F.expr(value))
    vectors = vectors.select("row_id", "terms", "values", F.expr(length).alias("length"))
    by_length = (F.desc("length"), F.asc("row_id"))
    return vectors.repartitionByRange(*by_length).sortWithinPartitions(*by_length)


@dataclass
class Query:
    """An item's terms from the heaviest to the lightest."""

    terms: np.ndarray
    weights: np.ndarray
    rest: np.ndarray  # length of what follows the first k terms
    by_term: np.ndarray  # order by term, to look weights up


def query(terms: np.ndarray, weights: np.ndarray) -> Query | None:
    keep = weights > 0
    terms, weights = terms[keep], weights[keep]
    if not len(terms):
        return None
    order = np.lexsort((terms, -weights))
    terms, weights = terms[order], weights[order]
    squares = weights.astype(np.float64) ** 2
    rest = np.sqrt(np.append(np.cumsum(squares[::-1])[::-1], 0.0))
    return Query(terms, weights, rest, np.argsort(terms, kind="stable"))


class Bucket:
    """Neighbours in the order of length, with their postings by term."""

    def __init__(self, b: pa.RecordBatch) -> None:
        self.ids = b.column(0)
        terms, values = b.column(1), b.column(2)
        self.starts = terms.offsets.to_numpy().astype(np.int64)
        base = self.starts[0]
        self.starts = self.starts - base
        self.terms = terms.values.to_numpy()[base : base + self.starts[-1]]
        self.values = values.values.to_numpy()[base : base + self.starts[-1]]
        self.lengths = b.column(3).to_numpy()
        self.longest = float(self.lengths.max())
        rows = np.repeat(np.arange(len(self.lengths)), np.diff(self.starts))
        order = np.argsort(self.terms, kind="stable")
        self.post_terms, self.post_rows = self.terms[order], rows[order]
        self.post_values = self.values[order].astype(np.float64)

    def survivors(self, q: Query, least: int) -> np.ndarray:
        """Rows whose score with the item may reach `least`."""
        reach = q.rest * self.longest * (1 + 1e-9)
        if reach[0] < least:
            return np.empty(0, np.int64)
        focus = int(np.searchsorted(-reach, -float(least), "right")) if least > 0 else len(q.terms)
        focus = min(focus, len(q.terms))
        low = np.searchsorted(self.post_terms, q.terms[:focus], "left")
        high = np.searchsorted(self.post_terms, q.terms[:focus], "right")
        counts = high - low
        total = int(counts.sum())
        if not total:
            return np.empty(0, np.int64)
        at = np.arange(total) + np.repeat(low - np.append(0, np.cumsum(counts)[:-1]), counts)
        rows, values = self.post_rows[at], self.post_values[at]
        n = len(self.lengths)
        part = np.bincount(rows, values * np.repeat(q.weights[:focus], counts), n)
        inside = np.bincount(rows, values * values, n)
        found = np.flatnonzero(inside)
        if focus == len(q.terms):
            bound = part[found]
        else:
            rest = np.sqrt(np.maximum(self.lengths[found] ** 2 * (1 + 1e-9) - inside[found], 0.0))
            bound = part[found] + q.rest[focus] * rest
        return found[bound * (1 + 1e-9) >= least]

    def scores(self, q: Query, rows: np.ndarray) -> np.ndarray:
        """Exact scores of `rows` (with a term each), in integers."""
        counts = self.starts[rows + 1] - self.starts[rows]
        begins = np.append(0, np.cumsum(counts)[:-1])
        at = np.arange(int(counts.sum())) + np.repeat(self.starts[rows] - begins, counts)
        terms, weights = q.terms[q.by_term], q.weights[q.by_term]
        slot = np.minimum(np.searchsorted(terms, self.terms[at]), len(terms) - 1)
        own = np.where(terms[slot] == self.terms[at], weights[slot], 0)
        return np.add.reduceat(own * self.values[at], begins)


class Lists:
    """The best `k` (score, id) of every item so far, and the score that an entry needs."""

    def __init__(self, queries: list[Query | None], k: int, least: np.ndarray) -> None:
        self.queries, self.k = queries, k
        self.least = np.maximum(least, 1)
        empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        self.best = [empty for _ in queries]

    def add(self, bucket: Bucket) -> None:
        ids = bucket.ids.fill_null(0).to_numpy(zero_copy_only=False)
        null = bucket.ids.is_null().to_numpy(zero_copy_only=False)
        for i, q in enumerate(self.queries):
            if q is None:
                continue
            rows = bucket.survivors(q, int(self.least[i]))
            if not len(rows):
                continue
            scores = bucket.scores(q, rows)
            ok = scores >= self.least[i]
            if not ok.any():
                continue
            rows = rows[ok]
            merged = [np.concatenate(p) for p in zip(self.best[i], (scores[ok], ids[rows], null[rows]), strict=True)]
            order = np.lexsort((merged[1], merged[2], -merged[0]))[: self.k]
            self.best[i] = tuple(p[order] for p in merged)
            if len(order) == self.k:
                self.least[i] = max(self.least[i], self.best[i][0][-1])

    def rows(self) -> Iterator[tuple]:
        for i, (scores, ids, null) in enumerate(self.best):
            for s, d, missing in zip(scores.tolist(), ids.tolist(), null.tolist(), strict=True):
                yield i, None if missing else d, s


HIT = pa.schema([("item", pa.int64()), ("row_id", pa.int64()), ("score", pa.int64())])


def best_of(vectors: DataFrame, queries: Broadcast, k: int, least: np.ndarray) -> DataFrame:
    """item, row_id, score: every task's best `k` of each item, from `least` upwards."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Lists(queries.value, k, least)
        for b in incoming:
            for at in range(0, b.num_rows, BUCKET):
                found.add(Bucket(b.slice(at, BUCKET)))
        rows = list(found.rows())
        for at in range(0, len(rows), 4096):
            yield batch(rows[at : at + 4096], HIT)

    return vectors.mapInArrow(run, "item long, row_id long, score long")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The best `k` of each item over all tasks, with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("row_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block: int = 200_000,
    seed_docs: int = 16_384,
) -> DataFrame:
    """item id, rank, document id, score: the `k` best documents with a score above 0, per row of `items`.

    `block` bounds the (item, term) pairs of a pass. `seed_docs` is about how many
    documents, drawn by a hash, are scored first; the k-th best of them is a lower bound
    from which the walk over all documents starts. It changes the work, never the rows.
    """
    spark = docs.sparkSession
    out, totals = work_dir(spark, "search"), None
    for b in blocks(items, item_col, item_text_col, block):
        words = spark.sparkContext.broadcast(b.vocabulary)
        counted = written(term_counts(docs, words, id_col, text_col), "search-terms")
        if totals is None:
            totals = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_docs, n_terms = totals
        if not n_docs:
            break
        # At most one row per term of the block.
        df = np.zeros(len(b.vocabulary), np.int64)
        for term, holders in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = holders
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        own = [query(t, weights[t] * c) for t, c in zip(b.terms, b.counts, strict=True)]
        queries = spark.sparkContext.broadcast(own)

        vectors = written(impacts(counted, n_docs, n_terms), "search-vectors")
        share = max(1, n_docs // seed_docs)
        seeds = vectors.where(F.pmod(F.xxhash64("row_id", "length"), F.lit(share)) == 0)
        least = np.zeros(len(own), np.int64)
        for item, worst in (
            ranked(best_of(seeds, queries, k, least), k).where(F.col("rank") == k).select("item", "score").collect()
        ):
            least[item] = worst
        found = ranked(best_of(vectors, queries, k, least), k)
        ids = pa.array(b.ids, pa.int64())
        named = F.broadcast(
            spark.createDataFrame(
                pa.table([pa.array(range(len(ids)), pa.int64()), ids], names=["item", "item_id"])
            )
        )
        found.join(named, "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "row_id", "score"
        ).write.mode("append").parquet(out)
        words.unpersist()
        queries.unpersist()
    schema = "item_id long, rank int, row_id long, score long"
    spark.createDataFrame([], schema).write.mode("append").parquet(out)
    result = spark.read.schema(schema).parquet(out)
    return result.select(
        F.col("item_id").alias(item_col), "rank", F.col("row_id").alias(id_col), "score"
    )
