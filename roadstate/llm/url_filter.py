"""URL verdicts: host and path rules, then gradient-boosted trees on lexical features.

Only DataFrame functions and the gradient-boosted trees of Spark ML: features, labels
and verdicts are columns.

The trees learn from labelled URLs; where no labels are given, the URLs that the rules
decide are the labels. Equal URLs of one label count once, with their number as weight, so
a URL with a third of all rows is one row of the fit. Suffix statistics are smoothed block
rates of the last one and two host labels over all labelled URLs; a row of the fit gets
them from the folds it is not in, so its own label is not among its features. The trees
are fitted on about `sample_rows` labelled URLs, chosen by a hash (a parameter).

Defined results: a null URL or one without `://` has an empty host and path and no rule;
the longest rule wins, then the one with the longer host; if the labels are all of one
kind that kind is the verdict of the rest, without labels it is allow; rows repeated
with one id are judged one by one; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import ascii_lower

NUMERIC = [
    "length", "host_length", "path_length", "labels", "depth", "digit_ratio", "hyphens", "entropy", "parameters",
    "query_length", "has_fragment", "secure", "suffix_rate", "domain_rate", "suffix_n",
]
#: Labelled URLs are dealt to so many folds by a hash of the URL.
FOLDS = 5


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what follows the path."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    # locate counts from 1; an absent separator is 0
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    return ascii_lower(host), path, F.substring(after, F.length(path) + 1, F.length(after))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null without one.

    `rules` are (verdict, 'host/path prefix'); few, as one expression holds them all.
    """
    split = [(verdict, text, *text.split("/", 1)) for verdict, text in rules]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text, name, tail in sorted(split, key=lambda r: (len(r[1]), len(r[2]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def lexical(frame: DataFrame) -> DataFrame:
    """Adds the features that need only the URL itself; expects url, host, path, rest."""
    url = F.coalesce("url", F.lit(""))
    n = F.length(url)
    share = lambda c: F.size(F.filter("chars", lambda x: x == c)) / F.greatest(n, F.lit(1))
    entropy = F.aggregate(
        F.array_distinct("chars"), F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c))
    )
    query = F.regexp_extract("rest", r"^\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    return (
        frame.withColumn("chars", F.split(url, ""))
        .withColumns(
            {
                "length": n,
                "host_length": F.length("host"),
                "path_length": F.length("path"),
                "labels": F.size(labels),
                "depth": F.size(F.array_remove(F.split("path", "/"), "")),
                "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(n, F.lit(1)),
                "hyphens": F.length(F.regexp_replace("host", "[^-]", "")),
                "entropy": entropy,
                "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
                "query_length": F.length(query),
                "has_fragment": F.col("rest").contains("#").cast("int"),
                "secure": url.startswith("https").cast("int"),
                "suffix": F.substring_index("host", ".", -1),
                "domain": F.substring_index("host", ".", -2),
            }
        )
        .drop("chars")
    )


def labelled_urls(known: DataFrame) -> DataFrame:
    """url, label, weight, fold, and the lexical features, per different (url, label)."""
    host, path, rest = parts(F.col("url"))
    different = known.groupBy("url", "label").agg(F.count(F.lit(1)).alias("weight"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS))
    return lexical(different.withColumns({"host": host, "path": path, "rest": rest, "fold": fold}))


def sums_by(marked: DataFrame, column: str, *more: str) -> DataFrame:
    return marked.groupBy(column, *more).agg(
        F.sum(F.col("weight") * F.col("label")).alias("blocked"), F.sum("weight").alias("n")
    )


def smooth(blocked: Column, n: Column, rate: float) -> Column:
    return (blocked + 5 * rate) / (n + 5)


def all_rates(marked: DataFrame, column: str, rate: float) -> DataFrame:
    """Block rate and number of labelled rows per suffix or domain."""
    found = sums_by(marked, column)
    return found.select(column, smooth(F.col("blocked"), F.col("n"), rate).alias(f"{column}_rate"), F.col("n").alias(f"{column}_n"))


def outside_rates(marked: DataFrame, column: str, rate: float) -> DataFrame:
    """The same per fold, from the other folds."""
    own = sums_by(marked, column, "fold")
    total = sums_by(marked, column).select(column, F.col("blocked").alias("all_blocked"), F.col("n").alias("all_n"))
    blocked, n = F.col("all_blocked") - F.col("blocked"), F.col("all_n") - F.col("n")
    return own.join(total, column).select(column, "fold", smooth(blocked, n, rate).alias(f"{column}_rate"), n.alias(f"{column}_n"))


def with_rates(df: DataFrame, tables: list[DataFrame], more: list[str], rate: float) -> DataFrame:
    """`df` with the rates of its suffix and domain; what is not known gets the overall rate."""
    for found in tables:
        column = found.columns[0]
        df = df.join(found, [column, *more], "left")
    return df.fillna({"suffix_rate": rate, "domain_rate": rate, "suffix_n": 0})


def assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=NUMERIC, outputCol="features").transform(df)


def fit(marked: DataFrame, rate: float, sample_rows: int, trees: int) -> GBTClassificationModel | None:
    """Trees on about `sample_rows` labelled URLs; None where they are all of one kind."""
    n = marked.count()
    pick = F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 20)) < min(1.0, sample_rows / max(1, n)) * (1 << 20)
    outside = [outside_rates(marked, c, rate) for c in ("suffix", "domain")]
    rows = with_rates(marked.where(pick), outside, ["fold"], rate)
    sample = assembled(rows).select("features", "label", F.col("weight").cast("double").alias("weight"))
    if sample.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    return GBTClassifier(maxIter=trees, maxDepth=4, seed=1, weightCol="weight").fit(sample)


def held_out(known: DataFrame, sample_rows: int = 20_000, trees: int = 10) -> DataFrame:
    """label, predicted, n over the URLs of one fold, judged by trees and rates of the other folds.

    `known` has url and label (0 or 1). Empty where the other folds have one kind of label.
    """
    marked = labelled_urls(known)
    test, train = marked.where("fold = 0"), marked.where("fold <> 0")
    totals = train.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("blocked")).first()
    rate = totals["blocked"] / totals["n"] if totals["n"] else 0.0
    model = fit(train, rate, sample_rows, trees) if 0 < rate < 1 else None
    if model is None:
        return known.sparkSession.createDataFrame([], "label double, predicted double, n long")
    full = [all_rates(train, c, rate) for c in ("suffix", "domain")]
    scored = model.transform(assembled(with_rates(test, full, [], rate)))
    predicted = (vector_to_array("probability")[1] >= 0.5).cast("double").alias("predicted")
    return scored.groupBy("label", predicted).agg(F.sum("weight").alias("n"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    labelled: DataFrame | None = None,
    sample_rows: int = 20_000,
    trees: int = 10,
) -> DataFrame:
    """id, host, path, rule, verdict ('allow' or 'block'), score, per row of `pages`.

    `labelled` may give (url, block) with block 0 or 1.
    """
    host, path, rest = parts(F.col("url"))
    split = lambda df: df.withColumns({"host": host, "path": path, "rest": rest})
    rows = split(pages.select(F.col(id_col).alias("row_id"), F.col(url_col).cast("string").alias("url")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = lexical(rows.withColumns({"rule": rule, "by_rule": verdict}))
    if labelled is None:
        known = rows.where("by_rule is not null").select("url", (F.col("by_rule") == "block").cast("double").alias("label"))
    else:
        known = labelled.select("url", F.col("block").cast("double").alias("label")).where("label in (0, 1)")
    marked = labelled_urls(known)

    totals = marked.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("blocked")).first()
    rate = totals["blocked"] / totals["n"] if totals["n"] else 0.0
    judged = rows.withColumn("score", F.lit(float(rate)))
    model = fit(marked, rate, sample_rows, trees) if 0 < rate < 1 else None
    if model is not None:
        full = [all_rates(marked, c, rate) for c in ("suffix", "domain")]
        scored = model.transform(assembled(with_rates(rows, full, [], rate)))
        judged = scored.withColumn("score", vector_to_array("probability")[1])
    by_method = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("row_id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "score"
    )
