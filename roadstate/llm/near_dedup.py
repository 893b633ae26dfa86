"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets are one class; a class is signed once. 24 bands of 5
hashes propose candidates: at similarity 0.8 a pair is missed with probability 7e-5, at
0.85 with 8e-7. Candidates are verified in two steps:

* Signature batches are compared one after the other; a pair goes as soon as the
  posterior probability that it reaches the threshold (uniform prior, so a Beta
  posterior) is below the miss probability.
* Survivors are confirmed on the full shingle sets.

No bucket is expanded into pairs. In every band bucket each member is compared with one
leader, which differs from band to band. Links so found give components. Only buckets
that still hold members of several components, beyond the pairs already compared, are
looked at again: their largest component is dealt over cells of at most `cell` members,
the others are copied to each cell, and a cell compares across components only. So every
pair of a bucket is compared or already connected, and no task holds a whole hot bucket.

Defined results: null, empty or blank texts have no shingles and no links; fewer words
than `k` are one shingle; a null id counts as the smallest and never names a component
with other ids; rows repeated with one id are one document; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import batches, checkpointed, held, text_or_empty, tuples, written
from roadstate.llm.components import components

BANDS, ROWS = 24, 5
HASHES = BANDS * ROWS
BATCH = 20  # hashes per signature batch
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit mixing generator."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


@functools.cache
def permutations() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * M1)
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


class WordHashes(dict):
    """64-bit hashes of words of up to 64 bytes, forgotten when the table is full."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            if len(self) > 300_000:
                self.clear()
            self[word] = value
        return value


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of runs of k words; all words if there are fewer."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(held("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))
    width = min(k, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for j in range(width):
        out = mix(out * M1 + h[j : len(h) - width + 1 + j])
    return np.unique(out)


def signature(values: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions, its upper 32 bits."""
    a, b = permutations()
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 512):
        hashed = np.multiply.outer(a, values[at : at + 512])
        hashed += b[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


@functools.cache
def fewest_matches(percent: int, miss: float) -> tuple[int, ...]:
    """Matches that a pair needs after each batch to stay a candidate.

    `miss` is for all batches together; each may spend an equal part of it.
    With m of n hashes equal the posterior of the similarity is Beta(m + 1, n - m + 1);
    P(similarity >= t) is then a binomial sum: P(Bin(n + 1, t) <= m).
    """
    t, each = percent / 100, miss / (HASHES // BATCH)
    needs = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while m < n:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= each:
                break
        needs.append(m)
    return tuple(needs)


def survivors(one: np.ndarray, many: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Rows of `many` that stay candidates of `one` after all signature batches."""
    left = np.arange(len(many))
    matches = np.zeros(len(many), np.int32)
    for i, need in enumerate(fewest_matches(percent, miss)):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches = matches + (many[left, part] == one[part]).sum(axis=1)
        stay = matches >= need
        left, matches = left[stay], matches[stay]
        if not len(left):
            break
    return left


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b|, on sorted distinct values."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


ARROW_SIGNED = pa.schema(
    [
        ("row_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("digest", pa.binary()),
        ("sig", pa.binary()),
        ("content", pa.binary()),
    ]
)


def sign(k: int):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last: tuple[bytes, tuple] = (b"", (0, b"", None, None))
            for row_id, text in tuples(incoming):
                if text != last[0]:
                    values = shingles(text, k)
                    if len(values):
                        digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                        last = (text, (len(values), digest, signature(values).tobytes(), zlib.compress(text, 1)))
                    else:
                        last = (text, (0, b"", None, None))
                yield row_id, *last[1]

        return batches(rows(), ARROW_SIGNED, 1024)

    return run


ARROW_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def verify_pairs(k: int, percent: int, miss: float):
    """Linked pairs of (a, sig_a, content_a, b, sig_b, content_b)."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last: tuple[int | None, np.ndarray] = (None, np.empty(0))
            for a, sig_a, content_a, b, sig_b, content_b in tuples(incoming):
                other = np.frombuffer(sig_b, np.uint32)[None, :]
                if len(survivors(np.frombuffer(sig_a, np.uint32), other, percent, miss)):
                    if a != last[0]:
                        last = (a, shingles(zlib.decompress(content_a), k))
                    if linked(last[1], shingles(zlib.decompress(content_b), k), percent):
                        yield a, b

        return batches(rows(), ARROW_LINK)

    return run


def cell_links(members: list[tuple], k: int, percent: int, miss: float) -> Iterator[tuple[int, int]]:
    """Links between different components among (node, root, moves, sig, content)."""
    parent = {m[1]: m[1] for m in members}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    sigs = np.stack([np.frombuffer(m[3], np.uint32) for m in members])
    sets: dict[int, np.ndarray] = {}

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingles(zlib.decompress(members[i][4]), k)
        return sets[i]

    for i, member in enumerate(members):
        if not member[2]:
            continue
        for j in survivors(sigs[i], sigs, percent, miss):
            j = int(j)
            if members[j][2] and j <= i:
                continue  # seen from the other side
            ra, rb = find(member[1]), find(members[j][1])
            if ra != rb and linked(full(i), full(j), percent):
                parent[max(ra, rb)] = min(ra, rb)
                yield member[0], members[j][0]


def verify_cells(k: int, percent: int, miss: float):
    """Links found in cells; rows come sorted by cell, a cell is held at a time."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, members = None, []
            for cell, *member in tuples(incoming):
                if cell != now:
                    yield from cell_links(members, k, percent, miss) if len(members) > 1 else ()
                    now, members = cell, []
                members.append(tuple(member))
            yield from cell_links(members, k, percent, miss) if len(members) > 1 else ()

        return batches(rows(), ARROW_LINK)

    return run


def mixed_cells(members: DataFrame, roots: DataFrame, cell: int) -> DataFrame:
    """(cell key, node, root, moves) for buckets with untested pairs across components.

    `members` has (bucket, node, leader, size).
    """
    placed = members.where("size > 2").join(roots, "node", "left").select(
        "bucket", "node", "size", F.coalesce("root", "node").alias("root"), (F.col("node") == F.col("leader")).alias("leads")
    )
    # Pairs with the leader are tested already: a bucket is done when the others share one component.
    per_root = placed.groupBy("bucket", "root").agg(
        F.count("*").alias("n"), F.sum((~F.col("leads")).cast("long")).alias("others")
    )
    buckets = (
        per_root.groupBy("bucket")
        .agg(
            F.max_by("root", F.struct("n", "root")).alias("main"),
            F.max("n").alias("n_main"),
            F.sum("n").alias("n"),
            F.sum((F.col("others") > 0).cast("long")).alias("roots"),
        )
        .where("roots > 1")
        .select(
            "bucket",
            "main",
            F.ceil(F.col("n_main") / cell).alias("main_parts"),
            F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("n_main")) / cell)).alias("other_parts"),
        )
    )
    some = placed.join(buckets, "bucket")
    moves = F.col("root") != F.col("main")
    part = F.when(moves, F.pmod(F.xxhash64("node"), "other_parts")).otherwise(F.pmod(F.xxhash64("node"), "main_parts"))
    # Cell (o, m) holds part o of the others and part m of the main component; cell
    # (o, -1 - p) holds parts o and p of the others, o < p.
    up_to = F.sequence(F.lit(0).cast("long"), F.col("main_parts") - 1)
    others = F.sequence(F.lit(0).cast("long"), F.col("other_parts") - 1)
    low = lambda p: F.least(p, F.col("part"))
    high = lambda p: F.greatest(p, F.col("part"))
    cells = F.when(
        F.col("moves"),
        F.concat(
            F.transform(up_to, lambda m: F.struct(F.col("part").alias("o"), m.alias("m"))),
            F.transform(
                F.filter(others, lambda p: p != F.col("part")),
                lambda p: F.struct(low(p).alias("o"), (-1 - high(p)).alias("m")),
            ),
        ),
    ).otherwise(F.transform(others, lambda o: F.struct(o.alias("o"), F.col("part").alias("m"))))
    return (
        some.select("bucket", "node", "root", moves.alias("moves"), part.alias("part"), "main_parts", "other_parts")
        .select("bucket", "node", "root", "moves", F.explode(cells).alias("at"))
        .select(F.xxhash64("bucket", "at.o", "at.m").alias("cell"), "node", "root", "moves")
    )


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
    cell: int = 256,
) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of
    k-word shingles; component_id is the smallest id reachable.
    """
    signed = written(
        docs.select(F.col(id_col).cast("long").alias("row_id"), text_or_empty(text_col).cast("binary").alias("text"))
        .mapInArrow(sign(k), "row_id long, n_shingles long, digest binary, sig binary, content binary")
        .withColumn("row", F.monotonically_increasing_id()),
        "signatures",
    )
    with_set = signed.where("n_shingles > 0")
    # A class is named by one of its rows, which also carries its signature and text.
    classes = checkpointed(
        with_set.groupBy("digest").agg(F.min("row").alias("node"), F.min("row_id").alias("low"))
    )
    nodes = with_set.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    band = F.posexplode(
        F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda i: F.xxhash64(F.substring(F.col("sig"), i * (4 * ROWS) + 1, F.lit(4 * ROWS)), i),
        )
    ).alias("band", "bucket")
    banded = nodes.select(F.col("row").alias("node"), band).select(
        "bucket", "node", F.xxhash64("node", "band").alias("rank")
    )
    buckets = (
        banded.groupBy("bucket")
        .agg(
            F.count("*").alias("size"),
            F.min(F.struct("rank", "node")).alias("first"),
            F.bit_xor(F.xxhash64("node")).alias("mark"),
            F.min("node").alias("low"),
            F.max("node").alias("high"),
        )
        .where("size > 1")
    )
    members = written(
        banded.join(buckets.select("bucket", "size", F.col("first.node").alias("leader"), "mark", "low", "high"), "bucket"),
        "band-members",
    )
    proposed = checkpointed(
        members.where("node <> leader")
        .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        .distinct()
    )
    candidate = checkpointed(proposed.select(F.col("a").alias("row")).union(proposed.select("b")).distinct())
    texts = written(
        signed.select("row", "sig", "content").join(candidate, "row", "left_semi"), "candidate-texts"
    )
    left = texts.select(F.col("row").alias("a"), F.col("sig").alias("sig_a"), F.col("content").alias("content_a"))
    right = texts.select(F.col("row").alias("b"), F.col("sig").alias("sig_b"), F.col("content").alias("content_b"))
    first = checkpointed(
        proposed.join(left, "a")
        .join(right, "b")
        .select("a", "sig_a", "content_a", "b", "sig_b", "content_b")
        .mapInArrow(verify_pairs(k, percent, miss), "a long, b long")
    )
    # Buckets with the same members are looked at once.
    single = members.groupBy("size", "mark", "low", "high").agg(F.min("bucket").alias("bucket")).select("bucket")
    again = members.join(single, "bucket", "left_semi").select("bucket", "node", "leader", "size")
    cells = mixed_cells(again, components(first), cell)
    second = checkpointed(
        cells.join(texts.withColumnRenamed("row", "node"), "node")
        .select("cell", "node", "root", "moves", "sig", "content")
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(verify_cells(k, percent, miss), "a long, b long")
    )
    reached = components(first.union(second))
    lows = classes.join(reached, "node", "left").select(
        "digest", "low", F.coalesce("root", "node").alias("root")
    )
    # Written first: the join then stands alone, and Spark can split a component with many classes.
    low = checkpointed(lows.groupBy("root").agg(F.min("low").alias("component_id")))
    named = lows.join(low, "root").select("digest", "component_id")
    rows = signed.select("row_id", "n_shingles", "digest")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("row_id"))
    # Documents without shingles have no class; each is its own component.
    key = F.when(F.col("n_shingles") > 0, F.col("digest")).otherwise(F.xxhash64("row_id").cast("string").cast("binary"))
    return (
        rows.withColumn("digest", key)
        .join(named, "digest", "left")
        .select(
            F.col("row_id").alias(id_col),
            "n_shingles",
            own.alias("component_id"),
            F.col("row_id").eqNullSafe(own).alias("kept"),
        )
    )
