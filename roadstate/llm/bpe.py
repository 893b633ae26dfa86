"""Byte-pair encoding and decoding.

A piece is encoded with a priority queue of merge ranks over a doubly linked list of
symbols; entries that no longer match the list are skipped when they come up. Decoding
joins the byte strings of the vocabulary.

Texts are cut at single spaces between visible characters, where the split pattern
always starts a new piece, so the ids of a chunk do not depend on its neighbours and
chunks seen before come from a bounded two-generation cache of the worker process.

Defined results: a null text is empty and has no ids; the text of a special token
becomes its id; very long pieces take n log n steps; an empty table gives an empty
result; other columns are neither read nor returned.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import batch, held, text_or_empty

# Fixed: the split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) (?=\S)")
UNCLEAR = re.compile(r"(?:^|\s) | (?:\s|$)")
CACHE = 400_000
#: Characters of the longest text a table keeps, and bytes of a table's generation.
LONGEST, CACHE_BYTES = 256, 64 << 20
#: What an entry takes besides its characters and ids.
ENTRY = 160


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


class Chunks(dict):
    """Chunk to ids as bytes; generations full by entries or bytes replace each other.

    Chunks beyond `LONGEST` characters, as texts without blanks have them, are not kept.
    """

    def __init__(self, make, limit: int, limit_bytes: int = CACHE_BYTES):
        super().__init__()
        self.make, self.limit, self.limit_bytes = make, limit, limit_bytes
        self.old, self.bytes = {}, 0

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > LONGEST:
            return self.make(chunk)
        if len(self) >= self.limit or self.bytes >= self.limit_bytes:
            self.old, self.bytes = dict(self), 0
            self.clear()
        found = self.old.get(chunk)
        if found is None:
            found = self.make(chunk)
        self[chunk] = found
        self.bytes += ENTRY + len(chunk) + len(found)
        return found


class BytePairCodec:
    def __init__(self, path: str, cache: int = CACHE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.byte_ids = [vocab[symbols[b]] for b in range(256)]
        # pair of ids -> rank, and rank -> (left, right, merged); a pair is left << 20 | right
        self.ranks: dict[int, int] = {}
        self.by_rank: list[tuple[int, int, int]] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = vocab[left], vocab[right]
            self.ranks.setdefault(a << 20 | b, rank)
            self.by_rank.append((a, b, vocab[left + right]))
        of_symbol = {s: b for b, s in symbols.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(of_symbol[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.split = regex.compile(PATTERN).findall
        self.pieces = Chunks(self.encode_piece, cache // 4, CACHE_BYTES // 4)
        self.first = Chunks(self.encode_chunk, cache // 8, CACHE_BYTES // 8)
        self.later = Chunks(lambda chunk: self.encode_chunk(" " + chunk), cache)

    def encode_piece(self, piece: str) -> bytes:
        """Merges of one piece in rank order, leftmost first."""
        ids = [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(ids)
        if n == 1:
            return array("I", ids).tobytes()
        get, by_rank, pop, push = self.ranks.get, self.by_rank, heapq.heappop, heapq.heappush
        # An entry is rank << 32 | position, so equal ranks come up from the left.
        queue = [
            rank << 32 | i
            for i, rank in enumerate(map(get, [a << 20 | b for a, b in zip(ids, ids[1:])]))
            if rank is not None
        ]
        heapq.heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            entry = pop(queue)
            i = entry & 0xFFFFFFFF
            left, right, new = by_rank[entry >> 32]
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: a neighbour has changed since
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = get(new << 20 | ids[k])
                if rank is not None:
                    push(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = get(ids[h] << 20 | new)
                if rank is not None:
                    push(queue, rank << 32 | h)
        return array("I", [i for i in ids if i >= 0]).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(chunk)))

    def encode_plain(self, text: str) -> bytes:
        first, *later = CUT.split(text) if UNCLEAR.search(text) else text.split(" ")
        return self.first[first] + b"".join(map(self.later.__getitem__, later))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.specials is None or not self.specials.search(text):
            return self.encode_plain(text)
        return b"".join(
            array("I", [self.special[part]]).tobytes() if part in self.special else self.encode_plain(part)
            for part in self.specials.split(text)
        )

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, array("I", ids))).decode("utf-8", "replace")


def codec(path: str) -> BytePairCodec:
    """One codec per worker process and vocabulary."""
    return held("bpe", BytePairCodec, path)


ARROW_IDS = pa.schema(
    [("row_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())]
)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (little-endian unsigned 32-bit), decoded text, per row.

    `path` names the vocabulary file on every executor.
    """

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in incoming:
            rows, size = [], 0
            for row_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = own.encode(text.as_py())
                rows.append((row_id, len(ids) // 4, ids, own.decode(ids)))
                size += len(ids)
                if size > 4 << 20:
                    yield batch(rows, ARROW_IDS)
                    rows, size = [], 0
            yield batch(rows, ARROW_IDS)

    base = docs.select(F.col(id_col).cast("long").alias("row_id"), text_or_empty(text_col).alias("text"))
    return base.mapInArrow(run, "row_id long, n_tokens long, ids binary, decoded string").withColumnRenamed(
        "row_id", id_col
    )
