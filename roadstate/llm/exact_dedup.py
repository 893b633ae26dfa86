"""Exact duplicates through Patricia-trie owners.

Texts go to partitions by length and content hash; each partition inserts the full
byte strings into a compressed radix trie whose terminal nodes keep the owner and
the number of rows. Equality is decided by the bytes on the path, never by the hash.

* Every map task runs the same trie over its own rows first, so a text that fills a
  third of the table crosses the network once per map task.
* A trie over its memory limit spills whole subtrees to an anonymous scratch file of
  the task (unlinked at creation, gone with the task like a spill of Spark's own sort)
  and works through them one after the other.
* Owners go back to the rows by content hash: a join whose large partitions adaptive
  execution may split.

Defined results: null text equals empty text; the smallest or largest id owns a
group, a null id counts as smallest; rows repeated with one id are one document and
carry the same decision; an empty table gives an empty result; other columns are
neither read nor returned.
"""

from __future__ import annotations

import hashlib
import pickle
import shutil
import tempfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import ascii_lower, batches, text_or_empty, tuples

OWNER_SCHEMA = "digest binary, size long, content binary, has_id boolean, owner long, rows long"
ARROW_OWNER = pa.schema(
    [
        ("digest", pa.binary()),
        ("size", pa.int64()),
        ("content", pa.binary()),
        ("has_id", pa.bool_()),
        ("owner", pa.int64()),
        ("rows", pa.int64()),
    ]
)
ARROW_CLASS = pa.schema([("digest", pa.binary()), ("has_id", pa.bool_()), ("owner", pa.int64()), ("rows", pa.int64())])


class Node:
    __slots__ = ("label", "kids", "owner", "rows", "spill")

    def __init__(self, label: bytes):
        self.label = label
        self.kids: dict[int, Node] = {}
        self.owner: int | None = None
        self.rows = 0
        self.spill: IO[bytes] | None = None


def shared_length(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of `a` and `b[start:]`, by halving."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[start + low : start + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """Compressed radix trie from byte strings to (owner, rows)."""

    NODE_BYTES = 400

    def __init__(self, largest: bool = True, limit: int | None = None):
        self.better = max if largest else min
        self.limit = limit
        self.root = Node(b"")
        self.size = 0

    def merge(self, node: Node, owner: int | None, rows: int) -> None:
        if node.rows and node.owner is not None and owner is not None:
            node.owner = self.better(node.owner, owner)
        elif not node.rows:
            node.owner = owner
        else:  # a null id is the smallest id
            node.owner = (owner if node.owner is None else node.owner) if self.better is max else None
        node.rows += rows

    def insert(self, key: bytes, owner: int | None, rows: int = 1) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((key, owner, rows), node.spill, 5)
                return
            if at == len(key):
                self.merge(node, owner, rows)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = Node(key[at:])
                self.merge(kid, owner, rows)
                self.grow(len(kid.label))
                return
            if not key.startswith(kid.label, at):
                cut = shared_length(kid.label, key, at)
                upper = Node(kid.label[:cut])
                kid.label = kid.label[cut:]
                upper.kids[kid.label[0]] = kid
                node.kids[key[at]] = kid = upper
                self.size += self.NODE_BYTES  # spilling waits until the key is in its place
            node, at = kid, at + len(kid.label)

    def grow(self, size: int) -> None:
        self.size += size + self.NODE_BYTES
        if self.limit is not None and self.size > self.limit:
            self.spill_subtrees()

    def entries(self, top: Node, prefix: bytes = b"") -> Iterator[tuple[bytes, int | None, int]]:
        """(full byte string, owner, rows) of the terminals below a node."""
        stack = [(top, prefix)]
        while stack:
            node, before = stack.pop()
            path = before + node.label
            if node.rows:
                yield path, node.owner, node.rows
            stack += [(kid, path) for kid in node.kids.values()]

    def spill_subtrees(self) -> None:
        """Moves all subtrees below the first branching to scratch files.

        Each holds fewer texts than the trie did, so work on a file ends.
        """
        top, prefix = self.root, b""
        while len(top.kids) == 1 and not top.rows:
            (top,) = top.kids.values()
            prefix += top.label
        for kid in top.kids.values():
            if kid.spill is None and (kid.kids or len(top.kids) > 1):
                scratch = tempfile.TemporaryFile()
                for entry in self.entries(kid, prefix):
                    pickle.dump(entry, scratch, 5)
                for below in self.spilled(kid):
                    below.seek(0)
                    shutil.copyfileobj(below, scratch)
                    below.close()
                kid.kids, kid.rows, kid.owner, kid.spill = {}, 0, None, scratch
        self.size = self.NODE_BYTES

    def spilled(self, top: Node) -> Iterator[IO[bytes]]:
        stack = [top]
        while stack:
            node = stack.pop()
            if node.spill is not None:
                yield node.spill
            stack += node.kids.values()

    def drain(self) -> Iterator[tuple[bytes, int | None, int]]:
        """All terminals; spilled subtrees are read again one by one."""
        yield from self.entries(self.root)
        waiting = list(self.spilled(self.root))
        self.root = Node(b"")
        while waiting:
            scratch = waiting.pop()
            scratch.seek(0)
            part = PatriciaTrie(self.better is max, self.limit)
            while True:
                try:
                    part.insert(*pickle.load(scratch))
                except EOFError:
                    break
            scratch.close()
            yield from part.entries(part.root)
            waiting += part.spilled(part.root)


def local_owners(largest: bool, limit: int):
    """One row per distinct text that a map task has seen since its last flush."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            trie = PatriciaTrie(largest)
            for row_id, text in tuples(incoming):
                trie.insert(text.lower(), row_id)  # bytes.lower maps A-Z only
                if trie.size > limit:
                    yield from described(trie)
                    trie = PatriciaTrie(largest)
            yield from described(trie)

        return batches(rows(), ARROW_OWNER, 512)

    def described(trie: PatriciaTrie) -> Iterator[tuple]:
        for content, owner, n in trie.drain():
            yield hashlib.sha256(content).digest(), len(content), content, owner is not None, owner, n

    return run


def final_owners(largest: bool, limit: int):
    """One row per distinct text of a partition; texts decide, hashes only name them."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(largest, limit)
        for content, has_id, owner, n in tuples(incoming):
            trie.insert(content, owner if has_id else None, n)
        return batches(
            ((hashlib.sha256(c).digest(), o is not None, o, n) for c, o, n in trie.drain() if n > 1), ARROW_CLASS
        )

    return run


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    largest: bool = True,
    memory: int = 96 << 20,
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z. `memory` bounds
    the bytes of a trie before a map task flushes it or a merge task spills subtrees.
    """
    base = docs.select(F.col(id_col).cast("long").alias("row_id"), text_or_empty(text_col).alias("content"))
    partial = base.select("row_id", F.col("content").cast("binary")).mapInArrow(
        local_owners(largest, memory), OWNER_SCHEMA
    )
    classes = (
        partial.repartition("size", "digest")
        .select("content", "has_id", "owner", "rows")
        .mapInArrow(final_owners(largest, memory), "digest binary, has_id boolean, owner long, rows long")
        .select(F.lower(F.hex("digest")).alias("text_sha256"), F.struct("has_id", "owner", "rows").alias("class"))
    )
    rows = base.select("row_id", F.sha2(ascii_lower(F.col("content")).cast("binary"), 256).alias("text_sha256"))
    keep = F.when(F.col("class").isNull(), F.col("row_id")).otherwise(F.col("class.owner"))
    return rows.join(classes, "text_sha256", "left").select(
        F.col("row_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("class.rows", F.lit(1)).cast("long").alias("group_size"),
        F.col("row_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
