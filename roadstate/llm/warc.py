"""WARC archives and a globally ordered capture index.

Writing: a record is one gzip member, as WARC files have it, so the index can name its
place in the compressed file and a reader can seek to it. Files hold about `file_bytes`
of records and are written by Spark's text sink and committer into any store: a gzip
member of less than 16 MB ends in a zero byte, and that byte is the sink's line separator
(a larger record gets an empty member behind it, which ends in one). Of captures with
equal payloads one is a response, the others revisit it; their payloads are dropped
before records are dealt to files.

Each file is sorted by URL key and capture time and so is one run of the index. Runs are
merged externally: range cuts over (key, time, id) give each merge task a slice of every
run. A slice is kept as the Arrow batches it came in, cut wherever its order breaks off
(a shuffle hands over the blocks of a run in any order), and read as a stream of a few
rows at a time; nothing is sorted again, a loser tree merges the streams. What a task
holds is bounded by `rows_per_range`. The cuts include time and id, so a URL with a third
of all captures is spread over many tasks.

Defined results: a null payload is empty; a null URL has an empty key and no target
header; a null page id counts as the smallest and is left out of the record; captures
repeated with one id are all responses if that id is the one to revisit; an empty table
gives empty archives; other columns are not read. A response whose payload does not have
the length and digest of its headers ends the reading with an error, or is marked with
`strict=False`.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstate.llm.common import batch, batches, slices, tuples, written

END = "\r\n\r\n"
#: Most groups of equal payloads (some 50 bytes each) that are broadcast.
BROADCAST_GROUPS = 1_000_000
#: Rows of a run that the merge decodes at once.
STREAM_ROWS = 512
EPOCH = 1_600_000_000  # capture times are not in the table: one second per page id


def header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def record_texts(pages: DataFrame, id_col: str, url_col: str, body_col: str, shortest: int) -> DataFrame:
    """(url_key, time, row_id, value): the records without their end, revisits without their payload."""
    base = pages.select(
        F.col(id_col).cast("long").alias("row_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(body_col), F.lit("")).alias("body"),
    ).select(
        "*",
        F.octet_length("body").alias("size"),
        F.sha1(F.col("body").cast("binary")).alias("digest"),
        F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("strong"),
    )
    # Groups that share a payload; sums and maxima are combined before the shuffle.
    shared = written(
        base.where(F.col("size") >= shortest)
        .groupBy("strong", "size")
        .agg(F.max("row_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("strong").alias("shared"), "first_id"),
        "shared-payloads",
    )
    if shared.count() <= BROADCAST_GROUPS:  # then no payload is shuffled to find its group
        shared = F.broadcast(shared)
    joined = base.join(shared, F.col("strong") == F.col("shared"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("row_id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    time = F.coalesce("row_id", F.lit(0)) + EPOCH
    target = F.regexp_replace("url", "%", "%25")
    for char, escaped in (("\r", "%0D"), ("\n", "%0A")):
        target = F.regexp_replace(target, char, escaped)
    lines = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("row_id"), F.lit(">"))),
        header("WARC-Target-URI", target),
        header("WARC-Date", F.date_format(F.timestamp_seconds(time), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first_id"), F.lit(">")))),
        F.when(
            revisit, F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    return joined.select(url_key(F.col("url")).alias("url_key"), time.alias("time"), "row_id", F.concat(lines, block).alias("value"))


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then the rest: com,example,www)/path?query."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)


def member(record: bytes) -> bytes:
    """A record as gzip members whose last byte is zero."""
    data = gzip.compress(record, 6, mtime=0)
    return data if data[-1] == 0 else data + gzip.compress(b"", mtime=0)


def members(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members without their last byte, which the sink writes."""
    schema = pa.schema([("value", pa.binary())])
    for b in incoming:
        chunk, size = [], 0
        for value in b.column(0):
            chunk.append((member(value.as_py() + END.encode())[:-1],))
            size += len(chunk[-1][0])
            if size >= 1 << 20:
                yield batch(chunk, schema)
                chunk, size = [], 0
        if chunk:
            yield batch(chunk, schema)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    shortest: int = 1000,
    file_bytes: int = 64 << 20,
) -> None:
    """One WARC record per page, in files of about `file_bytes` of records before compression.

    Records are dealt by a hash of URL, time and id, so neither a hot URL nor a hot
    payload makes a large file. Each file is sorted by URL key and time.
    """
    texts = record_texts(pages, id_col, url_col, body_col, shortest)
    sizes = pages.select(F.octet_length(F.coalesce(F.col(body_col), F.lit(""))).alias("size"))
    files = slices(sizes, F.col("size") + 400, file_bytes)
    (
        texts.repartition(files, F.xxhash64("url_key", "time", "row_id", F.octet_length("value")))
        .sortWithinPartitions("url_key", "time", "row_id")
        .select(F.col("value").cast("binary").alias("value"))
        .mapInArrow(members, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .text(folder)
    )


HEADERS = re.compile(rb"WARC/1\.[01]\r\n((?:[^\r\n]+\r\n)+)\r\n")
PAGE = re.compile(r"<urn:page:(-?\d+)>")
CAPTURE = (
    "url_key string, time string, has_id boolean, row_id long, run string, offset long, length long, "
    "payload_bytes long, digest string, record_type string, refers_to long, intact boolean"
)
ARROW_CAPTURE = pa.schema(
    [
        ("url_key", pa.string()),
        ("time", pa.string()),
        ("has_id", pa.bool_()),
        ("row_id", pa.int64()),
        ("run", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("intact", pa.bool_()),
    ]
)


def archive_members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a file, one decompressed at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        one, parts, pos = zlib.decompressobj(31), [], at
        while not one.eof:
            piece = view[pos : pos + (1 << 16)]
            if not piece:
                raise ValueError(f"the archive ends within the record at byte {at}")
            parts.append(one.decompress(piece))
            pos += len(piece)
        end = pos - len(one.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def record_of(content: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    found = HEADERS.match(content)
    if found is None:
        raise ValueError(f"no WARC record at byte {at}")
    fields = dict(line.split(": ", 1) for line in found[1].decode().split("\r\n") if line)
    return fields, content[found.end() : found.end() + int(fields["Content-Length"])]


def key_of(url: str) -> str:
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url)
    host = re.match(r"[^/?#]*", rest)[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :]


def page_number(value: str | None) -> int | None:
    found = PAGE.match(value or "")
    return int(found[1]) if found else None


def captures(strict: bool):
    """One index row per record, in the order of the file."""

    def one(run: str, offset: int, length: int, content: bytes) -> tuple:
        fields, block = record_of(content, offset)
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        row_id = page_number(fields.get("WARC-Record-ID"))
        intact = kind == "revisit" or (len(payload) == size and hashlib.sha1(payload).hexdigest() == digest)
        if strict and not intact:
            raise ValueError(f"damaged record at byte {offset} of {run}")
        key = key_of(unquote(fields.get("WARC-Target-URI", "")))
        refers = page_number(fields.get("WARC-Refers-To"))
        return key, fields["WARC-Date"], row_id is not None, row_id, run, offset, length, size, digest, kind, refers, intact

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for path, content in tuples(incoming):
                name = path.rsplit("/", 1)[-1]
                for offset, length, data in archive_members(content):
                    if data:  # an empty member only ends the one before it
                        yield one(name, offset, length, data)

        return batches(rows(), ARROW_CAPTURE, 2048)

    return run


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self.replay(i, building=True)

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if y is None:
            return x is not None or a < b
        return x is not None and (x[0] < y[0] or (x[0] == y[0] and a < b))

    def replay(self, winner: int, building: bool = False) -> None:
        """Plays the matches from a leaf to the top."""
        at = (winner + self.k) // 2
        while at > 0:
            loser = self.losers[at]
            if loser < 0:
                if building:
                    self.losers[at] = winner
                    return
            elif self.beats(loser, winner):
                self.losers[at], winner = winner, loser
            at //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[top := self.losers[0]]) is not None:
            yield head
            self.heads[top] = next(self.runs[top], None)
            self.replay(top)


class Stream:
    """Rows of a run in ascending order, kept as slices of the batches they came in."""

    def __init__(self) -> None:
        self.slices: list[pa.RecordBatch] = []

    def __iter__(self) -> Iterator[tuple]:
        for part in self.slices:
            for at in range(0, part.num_rows, STREAM_ROWS):
                for row in tuples(iter([part.slice(at, STREAM_ROWS)])):
                    yield place_of(row), row


def place_of(row: tuple) -> tuple:
    """Where a row stands in the index: URL key, time, id with null ids first."""
    return row[0].encode(), row[1], row[2], row[3] or 0


def streams(incoming: Iterator[pa.RecordBatch]) -> list[Stream]:
    """The ascending streams of what a range gets: a run's next rows go on where it stands, or begin a new one."""
    found: list[Stream] = []
    now: dict[str, tuple[Stream, tuple]] = {}
    for b in incoming:
        start, stream = 0, None
        for i, row in enumerate(tuples(iter([b.select(["url_key", "time", "has_id", "row_id", "run"])]))):
            run, place = row[4], place_of(row)
            mine = now.get(run)
            if mine is None or place < mine[1]:
                mine = (Stream(), place)
                found.append(mine[0])
            if mine[0] is not stream:
                if stream is not None:
                    stream.slices.append(b.slice(start, i - start))
                start, stream = i, mine[0]
            now[run] = (stream, place)
        if stream is not None:
            stream.slices.append(b.slice(start))
    return found


def merge_runs(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the slices that a range of the index gets from every run."""
    yield from batches((row for _, row in LoserTree(streams(incoming))), ARROW_CAPTURE, 2048)


def capture_index(
    spark: SparkSession, folder: str, rows_per_range: int = 200_000, strict: bool = True
) -> DataFrame:
    """Index rows of all archives, ascending by (URL key, time, id) over the partitions."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    runs = written(files.mapInArrow(captures(strict), CAPTURE), "capture-runs")
    parts = slices(runs, F.lit(1), rows_per_range)
    return runs.repartitionByRange(parts, "url_key", "time", "has_id", "row_id").mapInArrow(merge_runs, CAPTURE)


def read_record(data: bytes, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record that an index row names, from the bytes of its place."""
    return record_of(next(archive_members(data[offset : offset + length]))[2], offset)
