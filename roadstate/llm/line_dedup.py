"""Repeated lines through two Bloom filters.

1. Every task sets the bits of the line keys it meets in a once-seen filter, and of
   those it meets again in a twice-seen filter. Filters travel as compressed segments
   and are merged segment by segment: `twice |= other_twice | (once & other_once)`.
   No line of the corpus is missing from the twice filter if two documents have it.
2. Only suspected keys (all bits set in the twice filter) leave their task. Their
   documents are counted exactly, by the key itself.
3. Confirmed keys go back to the documents as lists of line numbers; the documents
   drop these lines.

The filter has a fixed size (`filter_bits`, a parameter; 2**26 bits are 8 MB), so what
is broadcast is bounded. On a larger corpus it fills up and more lines are suspected;
the result stays exact, only the saving shrinks, so raise it with the corpus.

Defined results: a null or empty text is one empty line; keys shorter than
`min_length` code points never drop; a key counts once per row of the table, so rows
repeated with one id count each; the earliest (id, line) is the first occurrence, a
null id comes first; an empty table gives an empty result. A column of `docs` other
than the text comes back unchanged whatever its name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import batch, batches, checkpointed, text_or_empty, tuples, written

SEGMENT = 1 << 16  # bits
SPACE = b" \t\n\x0b\x0c\r"
ARROW_SEGMENT = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
ARROW_SUSPECT = pa.schema(
    [
        ("row_id", pa.int64()),
        ("mark", pa.int64()),
        ("size", pa.int64()),
        ("key", pa.binary()),
        ("lines", pa.list_(pa.int32())),
    ]
)
ARROW_KEPT = pa.schema(
    [("row", pa.int64()), ("kept", pa.binary()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())]
)


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip(SPACE).lower() for line in text.split(b"\n")]


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else sum((b & 0xC0) != 0x80 for b in key)


def usable(keys: list[bytes], min_length: int) -> set[bytes]:
    """Distinct keys long enough to count."""
    if min_length <= 1:
        return {k for k in keys if k} if min_length == 1 else set(keys)
    return {k for k in keys if len(k) >= min_length and code_points(k) >= min_length}


class SeenFilter:
    """Once-seen and twice-seen Bloom filters with two probes per key."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.once = np.zeros((1 << bits) // 8, np.uint8)
        self.twice = np.zeros((1 << bits) // 8, np.uint8)

    def probes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return hashes & self.mask, (hashes >> np.uint64(32)) & self.mask

    @staticmethod
    def put(bits: np.ndarray, where: np.ndarray) -> None:
        np.bitwise_or.at(bits, where >> np.uint64(3), np.left_shift(1, where & np.uint64(7)).astype(np.uint8))

    @staticmethod
    def has(bits: np.ndarray, where: np.ndarray) -> np.ndarray:
        return (bits[where >> np.uint64(3)] >> (where & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def add(self, hashes: np.ndarray) -> None:
        """One hash per document and key."""
        values, counts = np.unique(hashes, return_counts=True)
        a, b = self.probes(values)
        again = (counts > 1) | (self.has(self.once, a) & self.has(self.once, b))
        for bits, keep in ((self.twice, again), (self.once, slice(None))):
            self.put(bits, a[keep])
            self.put(bits, b[keep])

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        a, b = self.probes(hashes)
        return self.has(self.twice, a) & self.has(self.twice, b)


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def filter_segments(bits: int, min_length: int):
    """The filters of one task, cut into the segments that have a bit."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = SeenFilter(bits)
        for b in incoming:
            keys: list[bytes] = []
            for text in b.column(0).to_pylist():
                keys += usable(line_keys(text), min_length)
            seen.add(hashes_of(keys))
        once = seen.once.reshape(-1, SEGMENT // 8)
        twice = seen.twice.reshape(-1, SEGMENT // 8)
        rows = (
            (int(i), zlib.compress(once[i].tobytes(), 1), zlib.compress(twice[i].tobytes(), 1))
            for i in np.flatnonzero(once.any(axis=1))
        )
        return batches(rows, ARROW_SEGMENT, 256)

    return run


def merge_segments(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds the segments of a partition; holds one pair of arrays per segment."""
    merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for segment, once, twice in tuples(incoming):
        a = np.frombuffer(zlib.decompress(once), np.uint8)
        b = np.frombuffer(zlib.decompress(twice), np.uint8)
        if segment in merged:
            seen, again = merged[segment]
            merged[segment] = (seen | a, again | b | (seen & a))
        else:
            merged[segment] = (a, b)
    rows = ((s, b"", zlib.compress(t.tobytes(), 6)) for s, (_, t) in merged.items() if t.any())
    yield from batches(rows, ARROW_SEGMENT, 256)


def suspect_rows(twice, bits: int, min_length: int):
    """(row_id, mark, bytes of all keys, key, line numbers) of suspected keys, for each document."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = SeenFilter(3)
        seen.mask = np.uint64((1 << bits) - 1)
        seen.twice = twice.value

        def rows() -> Iterator[tuple]:
            for row_id, mark, text in tuples(incoming):
                keys = line_keys(text)
                distinct = list(usable(keys, min_length))
                if not distinct:
                    continue
                lines: dict[bytes, list[int]] = {
                    distinct[i]: [] for i in np.flatnonzero(seen.suspects(hashes_of(distinct)))
                }
                if lines:
                    for n, key in enumerate(keys):
                        if key in lines:
                            lines[key].append(n)
                    size = sum(map(len, keys))
                    for key, where in lines.items():
                        yield row_id, mark, size, key, where

        return batches(rows(), ARROW_SUSPECT)

    return run


def drop_lines(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text without the listed lines, their number before and the number dropped."""
    for b in incoming:
        rows = []
        for row, text, lines in zip(*(c.to_pylist() for c in b.columns), strict=True):
            parts = text.split(b"\n")
            gone = set() if lines is None else {n for some in lines for n in some}
            kept = text if not gone else b"\n".join(p for n, p in enumerate(parts) if n not in gone)
            rows.append((row, kept, len(parts), len(gone)))
        yield batch(rows, ARROW_KEPT)


def without_first_copies(found: DataFrame, copy_percent: int) -> DataFrame:
    """(row_id, mark, lists of line numbers to drop), first copies spared.

    `found` has (row_id, mark, size, key_id, weight, lines). A document whose confirmed
    lines make `copy_percent` of its bytes or more is a copy; of every key the earliest
    copy keeps all its lines.
    """
    at = F.struct("row_id", "mark").alias("at")  # a null id is equal to a null id
    # Rows repeated with one id and text give their keys several times.
    lost = F.aggregate(F.collect_set(F.struct("key_id", "weight")), F.lit(0).cast("long"), lambda s, k: s + k["weight"])
    losing = found.groupBy(at).agg(lost.alias("lost"), F.first("size").alias("size"), F.collect_list("lines").alias("lines"))
    copies = losing.where(F.col("lost") * 100 >= F.col("size") * copy_percent).select(F.col("at").alias("copy"))
    stay = (
        found.select(at, "row_id", "mark", "key_id", "lines")
        .join(copies, F.col("at") == F.col("copy"), "left_semi")
        .groupBy("key_id")
        .agg(F.min(F.struct("row_id", F.col("lines")[0].alias("line"), "mark", "lines")).alias("first"))
        .groupBy(F.struct("first.row_id", "first.mark").alias("keeper"))
        .agg(F.flatten(F.collect_list("first.lines")).alias("stay"))
    )
    drop = F.transform("lines", lambda some: F.array_except(some, F.coalesce("stay", F.array().cast("array<int>"))))
    return losing.join(stay, F.col("at") == F.col("keeper"), "left").select("at.row_id", "at.mark", drop.alias("lines"))


def repeated_lines(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    min_docs: int,
    min_length: int,
    keep_first: bool,
    filter_bits: int,
    copy_percent: int | None = None,
) -> DataFrame:
    """(row_id, mark, lists of line numbers to drop) per document that loses a line."""
    spark = docs.sparkSession
    text = text_or_empty(text_col).cast("binary")
    segments = (
        docs.select(text.alias("text"))
        .mapInArrow(filter_segments(filter_bits, min_length), "segment int, once binary, twice binary")
        .repartition("segment")
        .mapInArrow(merge_segments, "segment int, once binary, twice binary")
        .select("segment", "twice")
    )
    twice = np.zeros((1 << filter_bits) // 8, np.uint8)
    for segment, packed in segments.toLocalIterator():  # at most 2**filter_bits / 8 bytes
        start = segment * (SEGMENT // 8)
        twice[start : start + SEGMENT // 8] = np.frombuffer(zlib.decompress(packed), np.uint8)
    shared = spark.sparkContext.broadcast(twice)
    suspects = written(
        docs.select(
            F.col(id_col).cast("long").alias("row_id"), F.xxhash64(text_col).alias("mark"), text.alias("text")
        ).mapInArrow(
            suspect_rows(shared, filter_bits, min_length),
            "row_id long, mark long, size long, key binary, lines array<int>",
        ),
        "line-suspects",
    )
    confirmed = (
        suspects.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct("row_id", F.col("lines")[0].alias("line"))).alias("first"))
        .where(F.col("n") >= min_docs)
        .select("key", "first")
    )
    # On its own, so that large partitions of the suspects can be split in the join.
    if copy_percent is not None and not keep_first:
        numbered = checkpointed(confirmed.select("key", F.monotonically_increasing_id().alias("key_id")))
        weight = F.octet_length("key").cast("long") * F.size("lines")
        found = suspects.join(numbered, "key").select(
            "row_id", "mark", "size", "key_id", weight.alias("weight"), "lines"
        )
        return without_first_copies(written(found, "line-drops"), copy_percent)
    found = suspects.join(checkpointed(confirmed), "key")
    lines = F.col("lines")
    if keep_first:
        lines = F.filter(
            lines, lambda n: ~(F.col("row_id").eqNullSafe(F.col("first.row_id")) & (n == F.col("first.line")))
        )
    return found.groupBy("row_id", "mark").agg(F.collect_list(lines).alias("lines"))


def stats_name(columns: list[str]) -> str:
    """`line_stats`, with underscores until no column has that name."""
    name = "line_stats"
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_length: int = 1,
    keep_first: bool = True,
    filter_bits: int = 26,
    copy_percent: int | None = None,
) -> DataFrame:
    """`docs` with repeated lines dropped from the text, plus `line_stats` (see `stats_name`).

    A key is the line without the white space around it, A-Z lower-cased. Keys found
    in at least `min_docs` rows lose all their lines, or all but the first occurrence.
    With `copy_percent` and without `keep_first`, documents that would lose at least that
    share of their bytes are copies of each other: the earliest of them that has a key
    keeps its lines, so what only copies hold stays once.
    The other columns come back as they are; `line_stats` is a struct of n_lines
    (before dropping) and n_dropped.
    """
    drops = repeated_lines(
        docs, id_col, text_col, min_docs, min_length, keep_first, filter_bits, copy_percent
    ).select(F.struct("row_id", "mark").alias("at"), "lines")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    at = F.struct(F.col(id_col).cast("long").alias("row_id"), F.xxhash64(text_col).alias("mark"))
    joined = docs.select(row, at.alias("here")).join(drops, F.col("here") == F.col("at"), "left")
    kept = joined.select(
        "row", F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")).cast("binary").alias("text"), "lines"
    )
    schema = (
        docs.select(row).schema.add("kept", "binary").add("n_lines", "long").add("n_dropped", "long")
    )

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in incoming:
            inner = pa.record_batch(
                [pa.array(range(b.num_rows), pa.int64()), b.column(1), b.column(2)], ["row", "text", "lines"]
            )
            (out,) = drop_lines(iter([inner]))
            yield pa.record_batch(
                [b.column(0), out.column(1), out.column(2), out.column(3)], ["row", "kept", "n_lines", "n_dropped"]
            )

    done = kept.mapInArrow(run, schema)
    columns = [
        F.col("kept").cast("string").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns
    ]
    return done.select(*columns, F.struct("n_lines", "n_dropped").alias(stats_name(docs.columns)))
