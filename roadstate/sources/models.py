"""Model versions in a folder, with an alias table.

Layout: ``<root>/versions/<run_id>/{pipeline,transitions,profiles}`` plus the
Parquet tables ``model_versions`` and ``aliases`` (one small file per publication).

An alias moves by compare and replace: a publication takes the number after the one it
saw, by creating a file that must not exist yet. Of two that saw the same number one
wins it; the other takes the next, or fails if it asked for exactly that one. The row
with the highest number is current, so equal clock times have an order.
"""

from __future__ import annotations

from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from roadstate.operators.clusters import StateModel
from roadstate.sources.tables import read_or_none

ALIAS = "champion"
ALIASES = "alias string, run_id string, path string, published_at timestamp, number long"


class AliasMoved(RuntimeError):
    """Somebody else moved the alias first."""


def _created(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; True for the one caller that did."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    return bool(file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(file))


def current_alias(spark: SparkSession, root: str, alias: str = ALIAS) -> Row | None:
    """The row the alias stands at: run_id, path, published_at, number."""
    aliases = read_or_none(spark, f"{root}/aliases", spark.createDataFrame([], ALIASES).schema)
    if aliases is None:
        return None
    newest = [F.desc_nulls_last("number"), F.desc("published_at"), F.desc("run_id")]
    return aliases.where(F.col("alias") == alias).orderBy(*newest).first()


def _take_number(spark: SparkSession, root: str, alias: str, expected: int | None) -> int:
    """The number of a new publication, which no other one can have."""
    current = current_alias(spark, root, alias)
    seen = (current.number or 0) if current else 0
    if expected is not None and seen != expected:
        raise AliasMoved(f"{alias} stands at {seen}, not at {expected}")
    number = seen + 1
    while not _created(spark, f"{root}/claims/{alias}/{number}"):
        if expected is not None:
            raise AliasMoved(f"{alias} is being moved to {number} by another publication")
        number += 1
    return number


def publish_model(
    spark: SparkSession,
    model: StateModel,
    root: str,
    run_id: str,
    alias: str = ALIAS,
    expected: int | None = None,
    published_at: datetime | None = None,
) -> str:
    """Save a version with its metrics and parameters, then move the alias to it.

    With ``expected`` the alias moves only if it stands at that number (0: not set yet)
    and ``AliasMoved`` is raised otherwise. ``published_at`` defaults to the current time.
    """
    path = f"{root}/versions/{run_id}"
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    transitions = [(int(c), int(n)) for c, n in model.transitions.items()]
    spark.createDataFrame(transitions, "cluster int, next_cluster int").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/transitions")
    profiles = [
        (int(c), p["status"], p["avg_speed"], p["avg_delay_minutes"], p["vehicle_count"], p["samples"])
        for c, p in model.profiles.items()
    ]
    spark.createDataFrame(
        profiles,
        "cluster int, status string, avg_speed double, avg_delay_minutes double, "
        "vehicle_count double, samples long",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/profiles")
    version = spark.createDataFrame(
        [
            (
                run_id,
                path,
                {k: float(v) for k, v in model.metrics.items()},
                {k: str(v) for k, v in model.params.items()},
            )
        ],
        "run_id string, path string, metrics map<string,double>, params map<string,string>",
    )
    number = _take_number(spark, root, alias, expected)
    now = F.current_timestamp() if published_at is None else F.lit(published_at).cast("timestamp")
    stamp = now.alias("published_at")
    version.select("*", stamp).coalesce(1).write.mode("append").parquet(f"{root}/model_versions")
    # Last: readers switch only when everything else is in place.
    moved = version.select(F.lit(alias).alias("alias"), "run_id", "path", stamp, F.lit(number).cast("long").alias("number"))
    moved.coalesce(1).write.mode("append").parquet(f"{root}/aliases")
    return path


def model_versions(spark: SparkSession, root: str) -> DataFrame | None:
    return read_or_none(spark, f"{root}/model_versions")


def load_model(spark: SparkSession, root: str, alias: str = ALIAS) -> StateModel | None:
    """The model behind ``alias``; None when there is none or its files cannot be read."""
    current = current_alias(spark, root, alias)
    if current is None:
        return None
    path = current["path"]
    try:
        pipeline = PipelineModel.load(f"{path}/pipeline")
        # k rows each.
        transitions = spark.read.parquet(f"{path}/transitions").collect()
        profiles = spark.read.parquet(f"{path}/profiles").collect()
    except (PySparkException, Py4JJavaError) as error:  # an unreadable version counts as absent
        print(f"model {path} is not available: {error}")
        return None
    return StateModel(
        pipeline,
        {r["cluster"]: r["next_cluster"] for r in transitions},
        {r["cluster"]: {k: v for k, v in r.asDict().items() if k != "cluster"} for r in profiles},
    )
