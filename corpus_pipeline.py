"""Cleaning of a document corpus: five stages, each a DataFrame to DataFrame function.

Every stage works on all rows that its predecessor kept. A document is its doc_id: rows
repeated with one id share a decision, also a null id. Stages but the last return the
columns they got, extra ones included; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstate.llm import bpe, decontaminate, line_dedup, near_dedup
from roadstate.llm import toxicity as toxic_texts
from roadstate.llm.common import bound_batches, table, written
from roadstate.llm.queries import VOCABULARY

TOXIC = 0.7
#: A document of which repeated lines make this share of the bytes is a copy, not a carrier of boilerplate.
COPY_PERCENT = 50


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is not in the one column of `gone`."""
    out = gone.toDF("__gone").distinct()
    return docs.join(out, docs["doc_id"].eqNullSafe(out["__gone"]), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores 0.7 or more go."""
    scored = toxic_texts.toxicity(docs, table(spark, sf_dir, "labels"), threshold=TOXIC)
    # Ids only: written before the rows are read again, so their size is known to the join.
    return without(docs, written(scored.where("predicted = 1").select("doc_id"), "pipeline-toxic"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go, but the first of several copies keeps its own.

    Rows that this leaves without text go too; n_chars follows the text.
    """
    bound_batches(spark)
    found = line_dedup.line_dedup(docs, min_docs=10, keep_first=False, copy_percent=COPY_PERCENT)
    stats = line_dedup.stats_name(docs.columns)
    emptied = (F.col(f"{stats}.n_dropped") > 0) & ~F.col("text").rlike(r"[^ \t\n\x0B\f\r]")
    kept = found.where(~emptied).drop(stats)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 % of their five-word shingles the smallest id stays."""
    bound_batches(spark)
    found = near_dedup.near_dedup(docs, k=5, percent=80)
    return without(docs, found.where(~F.col("kept")).select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select("doc_id"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the kept documents and the text they decode to."""
    bound_batches(spark)
    return bpe.bpe_round_trip(docs, VOCABULARY)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", encode),
]

#: No SQL states the network's scores; tests/llm holds the other stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
