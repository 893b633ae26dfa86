"""Token ids in bit-packed files.

Ids take the fewest bits that hold the vocabulary. A file is a run of segments; each
segment is one little-endian record, followed by one newline byte that the text sink
of Spark writes after a row:

    magic 'TIDS', version u32, width u32, ids per block u32, documents u64, ids u64,
    payload bytes u64
    per document: has_id u8, id i64, ids u32
    per block: offset u64 into the payload
    payload: blocks of packed ids, most significant bit first, each from a byte on

The per-document counts and block offsets give random access: `read_document` and
`read_range` unpack only the blocks they touch, `unpack` is vectorised.

Documents are range-partitioned by id, so file names, segments and rows are in
ascending id order. Files are written and read by Spark's own sources and committers:
any store works and a retried task leaves no half file.

Defined results: a null text has only the end id; a null id comes first; equal ids are
ordered by a hash of their text; an empty table writes no segment and reads as empty;
other columns are not read.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadstate.llm.bpe import PATTERN, byte_symbols
from roadstate.llm.common import batch, checkpointed, held, slices, text_or_empty, written

HEAD = struct.Struct("<4sIIIQQQ")
DOCUMENT = np.dtype([("has_id", "u1"), ("id", "<i8"), ("n", "<u4")])
MAGIC, VERSION, BLOCK = b"TIDS", 1, 4096
SEGMENT_IDS = 1 << 18
CUT = re.compile(r"(?<=\S) (?=\S)")
#: A space beside another blank.
UNCLEAR = re.compile(r" (?:(?<=\s )|(?=\s))")
#: First character whose class is not taken as settled.
SETTLED = "\u0250"
#: Bytes of text whose words are looked up together, and most words of the table.
AT_ONCE, CACHE = 4 << 20, 150_000
#: Bytes of the word table, characters of the longest word it keeps, and what a word takes besides its own bytes.
CACHE_BYTES, LONGEST, ENTRY = 48 << 20, 256, 16


def width_of(vocabulary: int) -> int:
    """Fewest bits for ids below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):  # whole bytes
        return ids.astype(f">u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    return np.packbits(bits.reshape(-1)).tobytes()


def unpack(data: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f">u{width // 8}", count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width).reshape(count, width)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - width :] = bits
    return np.packbits(wide, axis=1).view(">u4").reshape(-1).astype("<u4")


def segment(documents: list[tuple[int | None, bytes]], width: int) -> bytes:
    """One record of a file from (id, ids as little-endian unsigned 32-bit) pairs."""
    index = np.array([(i is not None, i or 0, len(ids) // 4) for i, ids in documents], DOCUMENT)
    ids = np.frombuffer(b"".join(ids for _, ids in documents), "<u4")
    blocks = [pack(ids[at : at + BLOCK], width) for at in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)], dtype="<u8")
    head = HEAD.pack(MAGIC, VERSION, width, BLOCK, len(documents), len(ids), int(offsets[-1]))
    return head + index.tobytes() + offsets[:-1].tobytes() + b"".join(blocks)


class Segment:
    """A record within the bytes of a file."""

    def __init__(self, data: memoryview, at: int):
        magic, version, self.width, self.block, docs, self.ids, size = HEAD.unpack_from(data, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no token segment at byte {at}")
        at += HEAD.size
        self.index = np.frombuffer(data, DOCUMENT, docs, at)
        at += docs * DOCUMENT.itemsize
        n_blocks = -(-self.ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", n_blocks, at)
        at += 8 * n_blocks
        self.payload = data[at : at + size]
        self.end = at + size
        self.starts = np.concatenate([[0], np.cumsum(self.index["n"], dtype=np.int64)])

    def read_range(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        parts = []
        for b in range(first, last + 1):
            end = int(self.offsets[b + 1]) if b + 1 < len(self.offsets) else len(self.payload)
            count = min(self.block, self.ids - b * self.block)
            parts.append(unpack(self.payload[int(self.offsets[b]) : end], count, self.width))
        base = first * self.block
        return np.concatenate(parts)[start - base : stop - base]

    def read_document(self, i: int) -> np.ndarray:
        return self.read_range(int(self.starts[i]), int(self.starts[i + 1]))

    def row_id(self, i: int) -> int | None:
        return int(self.index["id"][i]) if self.index["has_id"][i] else None


def segments(data: bytes) -> Iterator[Segment]:
    view, at = memoryview(data), 0
    while at < len(view):
        found = Segment(view, at)
        yield found
        at = found.end + 1  # the newline of the sink


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of `flat` one after the other, and where each of them ends."""
    ends = np.cumsum(lengths, dtype=np.int64)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    return flat[at], ends


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, each word once.

    Texts are cut at single spaces between visible characters; the split pattern of a
    byte-level vocabulary starts a piece there, so a word's ids do not depend on its
    neighbours. The distinct words of a batch are looked up in a bounded table, which keeps
    the words used last, and the ids of its texts are gathered from there. First words of
    texts, which have no space before them, go to the library one by one.

    Words the table lacks are cut into pieces by the vocabulary's split pattern. Pieces that
    are no words of the table, each once, are strung together for the library's model, and
    the byte lengths of its tokens tell where each piece ends. Words with characters beyond
    `SETTLED`, whose classes may differ between versions of Unicode, go to the library
    uncut, and so do texts with a special token's string.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = Tokenizer(self.tokenizer.model)  # the same merges, for pieces between spaces
        self.model.pre_tokenizer = CharDelimiterSplit(" ")
        self.pieces = regex.compile(PATTERN).findall
        # What stands for each byte in the vocabulary; 255 is in no text and parts the pieces.
        symbols = byte_symbols()
        self.symbols = "".join(symbols[b] for b in range(255)) + " "
        self.vocabulary = self.tokenizer.get_vocab_size()
        # A byte-level token has one character per byte.
        self.lengths = np.zeros(self.vocabulary, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(token)
        # The table: words, their ids one after the other, and the batch that used each last.
        self.words = pa.array([], pa.string())
        self.ids = np.empty(0, "<u4")
        self.counts = np.empty(0, np.int64)
        self.used = np.empty(0, np.int64)
        self.batch = 0

    @property
    def known(self) -> list[str]:
        return self.words.to_pylist()

    def library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def per_part(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of ids of each part of a text, from the ids of the whole and the parts' bytes."""
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(lengths)) + 1
        return np.diff(cuts, prepend=0)

    def by_model(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and how many each has."""
        found, counts = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for at in range(0, len(pieces), 4000):
            part = pieces.slice(at, 4000)
            data = b"\xff".join(part.cast(pa.binary()).to_pylist())
            joined = codecs.charmap_decode(data, "strict", self.symbols)[0]
            (coded,) = self.model.encode_batch_fast([joined], add_special_tokens=False)
            found.append(np.array(coded.ids, "<u4"))
            counts.append(self.per_part(found[-1], pc.binary_length(part).to_numpy()))
        return np.concatenate(found), np.concatenate(counts)

    def by_pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and how many each has, from their pieces."""
        cut = self.pieces(" " + " ".join(words))
        coded = pa.array(cut, pa.string()).dictionary_encode()
        distinct, codes = coded.dictionary, coded.indices.to_numpy()
        # A piece that is a word of the table needs no second encoding.
        word = pc.if_else(pc.starts_with(distinct, " "), pc.utf8_slice_codeunits(distinct, 1), None)
        at = pc.index_in(word, value_set=self.words, skip_nulls=True)
        ids, counts = self.by_model(distinct.filter(at.is_null()))
        at = at.fill_null(-1).to_numpy()
        flat = np.concatenate([self.ids, ids])
        number = np.empty(len(at), np.int64)
        number[at >= 0], number[at < 0] = self.counts[at[at >= 0]], counts
        starts = np.empty(len(at), np.int64)
        starts[at >= 0] = (np.cumsum(self.counts) - self.counts)[at[at >= 0]]
        starts[at < 0] = len(self.ids) + np.cumsum(counts) - counts
        found, ends = gathered(flat, starts[codes], number[codes])
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        last = np.searchsorted(np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))), np.cumsum(lengths))
        return found, np.diff(ends[last], prepend=0)

    def learn(self, words: list[str], blank: set[str]) -> np.ndarray:
        """Puts new words, of which those of `blank` end in one, into the table and returns their places."""
        alone = [i for i, word in enumerate(words) if word in blank] if blank else []
        way = np.array([word.isascii() or max(word) < SETTLED for word in words], np.int8)
        way[alone] = 2
        cut, uncut = np.flatnonzero(way == 1).tolist(), np.flatnonzero(way == 0).tolist()
        ids, counts = [self.ids], [self.counts]
        for at in range(0, len(cut), 1 << 17):
            found = self.by_pieces([words[i] for i in cut[at : at + (1 << 17)]])
            ids.append(found[0])
            counts.append(found[1])
        for at in range(0, len(uncut), 2000):
            part = [" " + words[i] for i in uncut[at : at + 2000]]
            ids += self.library(["".join(part)])
            counts.append(self.per_part(ids[-1], np.array([len(w.encode()) for w in part])))
        ids += (found := self.library([" " + words[i] for i in alone]))
        counts.append(np.array([len(f) for f in found], np.int64))
        order, base = cut + uncut + alone, len(self.words)
        self.words = pa.concat_arrays([self.words, pa.array([words[i] for i in order], pa.string())])
        self.ids, self.counts = np.concatenate(ids), np.concatenate(counts)
        self.used = np.append(self.used, np.zeros(len(order), np.int64))
        places = np.empty(len(order), np.int64)
        places[order] = base + np.arange(len(order))
        return places

    def forget(self, learned: list[str], blank: set[str]) -> None:
        """Drops words that are not to be kept, and the older half of a full table."""
        odd = [*blank, *(w for w in learned if len(w) > LONGEST)]
        size = len(self.words) * ENTRY + self.words.nbytes + self.ids.nbytes
        if not odd and len(self.words) <= CACHE and size <= CACHE_BYTES:
            return
        keep = pc.invert(pc.is_in(self.words, value_set=pa.array(odd, pa.string()))).to_numpy(zero_copy_only=False)
        if len(self.words) > CACHE or size > CACHE_BYTES:
            by_use = np.argsort(-self.used, kind="stable")
            keep[by_use[min(CACHE, len(self.words)) // 2 :]] = False
        rows = np.flatnonzero(keep)
        self.ids, _ = gathered(self.ids, (np.cumsum(self.counts) - self.counts)[rows], self.counts[rows])
        self.words, self.counts, self.used = self.words.take(pa.array(rows)), self.counts[rows], self.used[rows]

    def coded(self, lists: pa.Array, rows: np.ndarray, found: list, clear: bool) -> np.ndarray:
        """Puts the ids of texts, given as lists of words, into `found`.

        Returns the rows left out, as they have a blank beside a space (`clear`: none has).
        """
        offsets = lists.offsets.to_numpy()
        values, offsets = lists.flatten(), offsets - offsets[0]
        firsts = values.take(pa.array(offsets[:-1])).to_pylist()
        is_later = np.ones(len(values), bool)
        is_later[offsets[:-1]] = False
        per_text = np.diff(offsets) - 1
        ends = np.cumsum(per_text)
        split = values.filter(pa.array(is_later)).dictionary_encode()
        codes = split.indices.to_numpy()
        at = pc.index_in(split.dictionary, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        words = split.dictionary.take(pa.array(new)).to_pylist()
        # No word of the table begins or ends in a blank. The last one of a text may end in one.
        blank = {w for w in words if not w or w != w.strip()} if words and UNCLEAR.search(f" {' '.join(words)} ") else set()
        if not clear:
            odd = np.array([bool(n) and (not f or f[-1].isspace()) for f, n in zip(firsts, per_text, strict=True)], bool)
            if blank:
                begins, stops = np.zeros(len(at), bool), np.zeros(len(at), bool)
                for code, word in zip(new.tolist(), words, strict=True):
                    if word in blank:
                        begins[code], stops[code] = not word or word[0].isspace(), True
                inner = stops[codes]
                inner[ends[per_text > 0] - 1] = False
                odd[np.searchsorted(ends, np.flatnonzero(inner | begins[codes]), side="right")] = True
            if odd.any():
                self.coded(lists.take(pa.array(np.flatnonzero(~odd))), rows[~odd], found, True)
                return rows[odd]
        at[new] = self.learn(words, blank)
        self.batch += 1
        self.used[at] = self.batch
        starts = np.cumsum(self.counts) - self.counts
        one_by_one = self.library(firsts)
        first = 0
        while first < len(rows):
            begin = ends[first] - per_text[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + (1 << 17), side="right")))
            some = at[codes[begin : ends[last - 1]]]
            ids, cuts = gathered(self.ids, starts[some], self.counts[some])
            data, cuts = memoryview(ids.tobytes()), np.append(0, 4 * cuts)
            for i in range(first, last):
                part = data[cuts[ends[i] - per_text[i] - begin] : cuts[ends[i] - begin]]
                found[rows[i]] = one_by_one[i].tobytes() + bytes(part)
            first = last
        self.forget(words, blank)
        return rows[:0]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
        found: list[bytes] = []
        for start, end in zip(cuts, cuts[1:]):
            found += self.encode_slice(texts.slice(start, end - start))
        return found

    def encode_slice(self, texts: pa.Array) -> list[bytes]:
        found: list[bytes | None] = [None] * len(texts)
        special = np.zeros(len(texts), bool)
        for s in self.specials:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(special).tolist():
            found[i] = self.library([texts[i].as_py()])[0].tobytes()
        rows = np.flatnonzero(~special)
        odd = self.coded(pc.split_pattern(texts.take(pa.array(rows)), " "), rows, found, False)
        cut = pa.array([CUT.split(texts[i].as_py()) for i in odd.tolist()], pa.list_(pa.string()))
        self.coded(cut, odd, found, True)
        return found


def encoder(path: str) -> LibraryEncoder:
    """One encoder per worker process and vocabulary."""
    return held("token files", LibraryEncoder, path)


def packed_segments(path: str, end_id: int):
    """Segments of a partition, in the order of its rows."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        width = width_of(max(own.vocabulary, end_id + 1))
        schema = pa.schema([("segment", pa.binary())])
        documents, size = [], 0
        end = struct.pack("<I", end_id)
        for b in incoming:
            for row_id, ids in zip(b.column(0).to_pylist(), own.encode(b.column(1)), strict=True):
                documents.append((row_id, ids + end))
                size += len(ids) // 4 + 1
                if size >= SEGMENT_IDS:
                    yield batch([(segment(documents, width),)], schema)
                    documents, size = [], 0
        if documents:
            yield batch([(segment(documents, width),)], schema)

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = 32 << 20,
) -> None:
    """Encodes every text, appends `end_id` and writes files of about `file_bytes` of text.

    `path` names the tokenizer file on every executor, `folder` a place in the store.
    """
    text = text_or_empty(text_col)
    base = docs.select(
        F.col(id_col).cast("long").alias("row_id"), text.alias("text"), F.monotonically_increasing_id().alias("row")
    )
    parts = slices(base, F.octet_length("text") + 16, file_bytes)
    order = ["row_id", F.xxhash64("text"), "row"]
    (
        base.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("row_id", "text")
        .mapInArrow(packed_segments(path, end_id), "segment binary")
        .select(F.col("segment").cast("string").alias("value"))
        .write.option("lineSep", "\n")
        .text(folder)
    )


ARROW_READ = pa.schema(
    [
        ("file", pa.string()),
        ("row_id", pa.int64()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def unpacked(with_ids: bool):
    """Documents of whole files; without `with_ids` the ids stay in the task and only their crc32 leaves."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in incoming:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                before = 0
                for s in segments(content.as_py()):
                    data, starts = memoryview(s.read_range(0, s.ids).tobytes()), s.starts.tolist()
                    for first in range(0, len(s.index), 500):
                        rows = []
                        for i in range(first, min(first + 500, len(s.index))):
                            a, z = starts[i], starts[i + 1]
                            ids = data[4 * a : 4 * z]
                            rows.append((name, s.row_id(i), before + a, z - a, zlib.crc32(ids), bytes(ids) if with_ids else None))
                        yield batch(rows, ARROW_READ)
                    before += s.ids

    return run


def totals(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("ids", pa.int64())])
    for b in incoming:
        yield batch(
            [
                (name, sum(s.ids for s in segments(content.as_py())))
                for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True)
            ],
            schema,
        )


#: Files whose totals one task adds up, and the most totals that are broadcast.
FILES_A_GROUP, BROADCAST_FILES = 1000, 100_000


def file_starts(per_file: DataFrame) -> DataFrame:
    """file, file_start: ids in all files before it, from (file, ids).

    Sums of sums: within groups of consecutive files, then over the groups, so no task
    sees more than a group's files or one row per group.
    """
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    placed = per_file.withColumn("part", F.floor(number / FILES_A_GROUP))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = placed.groupBy("part").agg(F.sum("ids").alias("in_part"))
    groups = groups.select("part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.select("part", "file", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("in_front"))
    return own.join(groups, "part").select("file", (F.col("part_start") + F.col("in_front")).alias("file_start"))


def read_token_files(
    spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids_crc32 and, unless left out, ids, per document.

    The starts of files (one row each) are broadcast while they are at most
    `BROADCAST_FILES`; beyond that documents are joined to them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    schema = "file string, row_id long, before long, n_tokens long, ids_crc32 long, ids binary"
    rows = named.mapInArrow(unpacked(with_ids), schema)
    if with_ids:
        per_file = checkpointed(named.mapInArrow(totals, "file string, ids long"))
    else:  # the rows are narrow, so files need not be read again for their totals
        rows = written(rows, "token-rows")
        per_file = rows.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    starts = file_starts(per_file)
    if len(files.inputFiles()) <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    start = (F.col("file_start") + F.col("before")).alias("start")
    found = rows.join(starts, "file").select(F.col("row_id").alias(id_col), start, "n_tokens", "ids_crc32", "ids")
    return found if with_ids else found.drop("ids")
