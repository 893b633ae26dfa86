"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of the k-gram hashes in each sliding window the smallest is the fingerprint. A span of
`window` words has exactly one, so every shared span of that length shares it:

1. The fingerprints of all item windows form the probe table. It is broadcast in
   blocks of at most `block` fingerprints, each block in a pass of its own.
2. Documents explode their fingerprints and keep those that the block has (whole-stage
   code; the word array is only referenced until a row survives).
3. Survivors are extended to the whole window and joined with the item windows on the
   words themselves, so hash collisions never count.

Items of fewer words are one window; their exact length is added as a fingerprint of
its own (k-gram of all words, window of one), so they are found anywhere, too.

Defined results: a null text has no words; a null item id is the empty id; repeated
items count once; every row of the documents gives one row, rows repeated with one id
included; an empty benchmark leaves all documents clean; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import ascii_lower, checkpointed, text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 5
SENTINEL = 0


def words_of(text: Column) -> Column:
    """Maximal runs of digits, lower-cased letters and characters beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def positions(n: Column, length: int) -> Column:
    """0 .. n - length, or nothing."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def fingerprints(words: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds `grams`, the k-gram hashes, to a frame with `words` and `n`, then `prints`:
    the smallest of the `window - gram + 1` hashes of the window at each position."""
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn(
        "grams",
        F.transform(
            positions(F.col("n"), gram), lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + j) for j in range(gram)])
        ),
    )
    width = window - gram + 1
    if width == 1:
        return grams.withColumn("prints", F.col("grams"))
    return grams.withColumn(
        "prints",
        F.transform(
            positions(F.col("n"), window), lambda i: F.least(*[F.get(F.col("grams"), i + j) for j in range(width)])
        ),
    )


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(size, phrase, print, items) per distinct window of the benchmark."""
    # Cut here: the plans below use the words many times over.
    words = checkpointed(
        benchmark.select(
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
            words_of(text_or_empty(text_col)).alias("words"),
        ).withColumn("n", F.size("words"))
    )
    sizes = words.where("n > 0").select(F.least("n", F.lit(window)).alias("size")).distinct().collect()  # <= `window`
    parts = []
    for size in sorted({window} | {r["size"] for r in sizes}):
        gram = min(GRAM, window) if size == window else size
        some = words.where(F.col("n") >= size if size == window else F.col("n") == size)
        parts.append(
            fingerprints(some, size, gram)
            .select("item", "words", F.posexplode_outer("prints").alias("at", "print"))
            .select(
                F.lit(size).alias("size"),
                F.concat_ws(" ", F.slice("words", F.col("at") + 1, size)).alias("phrase"),
                "print",
                "item",
            )
        )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("size", "phrase", "print")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def covered(starts: Column) -> Column:
    """Words under any of the spans, given as sorted structs of (start, size)."""
    # State: (end of the covered part, words covered).
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))

    def step(state: Column, span: Column) -> Column:
        end = span["at"] + span["size"]
        new = F.greatest(F.lit(0), end - F.greatest(span["at"], state["end"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["words"] + new).alias("words"))

    return F.aggregate(starts, zero, step, lambda state: state["words"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block: int = 500_000,
) -> DataFrame:
    """id, n_words, n_hit, n_items, items (sorted ids), contaminated, per row of `docs`.

    A window is `window` consecutive words of an item (all words of a shorter one); a
    document word inside an occurrence of a window is hit.
    """
    windows = checkpointed(item_windows(benchmark, item_col, item_text_col, window))
    known = windows.groupBy("size").agg(F.countDistinct("print").alias("prints")).collect()  # <= `window` rows
    sizes = sorted((r["size"] for r in known), reverse=True)
    blocks = max(1, -(-sum(r["prints"] for r in known) // block))

    # One pass over the documents: row number, words, and the fingerprints of every size
    # in one array; the last entry stands for the document itself.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("row_id"),
        words_of(text_or_empty(text_col)).alias("words"),
    ).withColumn("n", F.size("words"))
    arrays = []
    for size in sizes:
        gram = min(GRAM, window) if size == window else size
        rows = fingerprints(rows, size, gram).withColumnRenamed("prints", f"prints_{size}").drop("hashes", "grams")
        arrays.append(F.col(f"prints_{size}"))
    rows = rows.select("row", "row_id", "words", "n", F.concat(*arrays, F.array(F.lit(SENTINEL).cast("long"))).alias("prints"))
    # The outer form: the inner one would be planned with a filter on the array's size,
    # which moves below the projections and computes the arrays inside each other.
    exploded = rows.select("row", "row_id", "words", "n", F.posexplode_outer("prints").alias("slot", "print"))

    prints = windows.select("print").distinct()
    found = []
    for b in range(blocks):
        mine = prints.where(F.pmod("print", F.lit(blocks)) == b)
        if b == 0:
            mine = mine.unionByName(docs.sparkSession.range(1).select(F.lit(SENTINEL).cast("long").alias("print"))).distinct()
        found.append(exploded.join(F.broadcast(mine), "print", "left_semi"))
    hits = reduce(DataFrame.unionByName, found)

    # The slot tells size and position; the slot after all of them is the document.
    size, at, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for s in sizes:
        count = F.greatest(F.col("n") - s + 1, F.lit(0))
        inside = (F.col("slot") >= before) & (F.col("slot") < before + count)
        size = F.when(inside, F.lit(s)).otherwise(size)
        at = F.when(inside, F.col("slot") - before).otherwise(at)
        before = before + count
    placed = hits.select("row", "row_id", "words", "n", size.alias("size"), at.alias("at"), (F.col("slot") == before).alias("whole"))
    phrases = placed.where(F.col("whole") | F.col("size").isNotNull()).select(
        "row",
        "row_id",
        "n",
        "size",
        "at",
        F.when(F.col("size").isNull(), F.concat(F.lit("\n"), F.col("row").cast("string")))
        .otherwise(F.concat_ws(" ", F.slice("words", F.col("at") + 1, F.coalesce("size", F.lit(0)))))
        .alias("phrase"),
    )
    matched = phrases.join(windows.select("phrase", "items"), "phrase", "left").where(
        F.col("items").isNotNull() | F.col("size").isNull()
    )
    span = F.when(F.col("items").isNotNull(), F.struct("at", "size"))
    return (
        matched.groupBy("row", "row_id", "n")
        .agg(F.sort_array(F.collect_set(span)).alias("spans"), F.collect_set("items").alias("items"))
        .select(
            F.col("row_id").alias(id_col),
            F.col("n").cast("long").alias("n_words"),
            covered(F.col("spans")).alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
        )
        .select(
            id_col,
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            "items",
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )
