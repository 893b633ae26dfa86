"""Small helpers that several text operators share."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstate.session import shared_dir, work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    `lower` maps all of Unicode, so it serves only texts without multi-byte
    characters, where it is the faster of the two.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(row_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fold_of(row_id: object, modulus: int) -> int:
    return zlib.crc32(b"" if row_id is None else str(row_id).encode()) % modulus


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows, written once below the shared folder and read from there.

    With `by` there is a folder per value of that column, and readers of one value read
    no other.

    Cuts the lineage: tasks run again after a lost executor read the files, and
    ids that are unique but not reproducible keep the value they were written with.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Eager checkpoint in the shared folder, for tables of a few columns.

    `parts` is the most partitions of a table whose size is known: small tables that are
    written and shuffled again and again should not do so in hundreds of files.
    """
    if parts is not None:
        df = df.coalesce(parts)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    chunk: list[tuple] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) >= size:
            yield batch(chunk, schema)
            chunk = []
    if chunk:
        yield batch(chunk, schema)


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def tuples(incoming: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values, one batch at a time."""
    for b in incoming:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


#: Bytes of an Arrow batch between Spark and a Python worker. The default of Spark, 64 MB,
#: is held several times over on both sides.
ARROW_BYTES = 8 << 20


def bound_batches(spark: SparkSession, limit: int = ARROW_BYTES) -> None:
    """Keep the session's Arrow batches at `limit` bytes, or below if they are already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < now <= limit:
        spark.conf.set(name, str(limit))


_HELD: dict[tuple, object] = {}


def held(name: str, make: Callable, *args):
    """`make(*args)`, kept by the worker process until another thing is held.

    Workers are used again by later stages; so they hold the tables of one operator and
    not those of all that ran before.
    """
    key = (name, *args)
    if key not in _HELD:
        release()
        _HELD[key] = make(*args)
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the system.

    Without it a process that ran several operators keeps the largest heap that any of
    them needed, beside what the next one takes.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def release() -> None:
    """Let go of what the worker process holds."""
    if _HELD:
        _HELD.clear()
        give_back()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def slices(df: DataFrame, size: Column, target: int) -> int:
    """Number of partitions that hold about `target` bytes each."""
    total = df.select(F.sum(size)).first()[0] or 0
    return max(1, -(-int(total) // target))
