"""Traffic-state clusters: preparation, fitting, profiles, transitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstate.operators import kmeans
from roadstate.operators.aggregates import NotEnoughRows, require_rows
from roadstate.operators.metrics import silhouette
from roadstate.operators.quantiles import exact_medians
from roadstate.schemas import MODEL_FEATURES, ROUTE_KEYS

# Model parameters and status names by rank of mean delay.
CLUSTERS, SEED, RESTARTS, HORIZON_MINUTES, MIN_TRAINING_ROWS = 3, 42, 10, 30, 50
STATUS_NAMES = ("clear", "moderate", "congested")


@dataclass(frozen=True)
class Scaling:
    """Per-feature fill value, mean and scale (a handful of numbers each)."""

    features: tuple[str, ...]
    fill: tuple[float, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    empty: tuple[str, ...] = ()


def learn_scaling(
    df: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES), stored: bool = False
) -> Scaling:
    """Median fill, then mean and population deviation of the filled values.

    A feature without any value is filled with 0 and listed in ``empty``; a
    feature without variance is scaled by 1. ``stored``: see ``exact_medians``.
    """
    medians = exact_medians(df, features, stored=stored)
    fill = {f: 0.0 if medians[f] is None else medians[f] for f in features}
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(fill[f])) for f in features}
    stats = df.agg(
        *[F.avg(c).alias(f"{f}|mean") for f, c in filled.items()],
        *[F.stddev_pop(c).alias(f"{f}|std") for f, c in filled.items()],
        # A constant column has no exact-zero deviation in floating point.
        *[(F.max(c) == F.min(c)).alias(f"{f}|flat") for f, c in filled.items()],
    ).first()
    return Scaling(
        tuple(features),
        tuple(fill[f] for f in features),
        tuple(stats[f"{f}|mean"] for f in features),
        tuple(1.0 if stats[f"{f}|flat"] else stats[f"{f}|std"] for f in features),
        tuple(f for f in features if medians[f] is None),
    )


def scaled(df: DataFrame, scaling: Scaling) -> dict[str, Column]:
    """Filled and standardised features as ``z_<feature>`` columns."""
    missing = F.lit(None).cast("double")
    return {
        f"z_{f}": (
            F.coalesce(F.col(f).try_cast("double") if f in df.columns else missing, F.lit(fill))
            - F.lit(mean)
        )
        / F.lit(scale)
        for f, fill, mean, scale in zip(
            scaling.features, scaling.fill, scaling.mean, scaling.scale, strict=True
        )
    }


def state_pipeline(
    scaling: Scaling, centroids: Sequence[Sequence[float]], output: str = "current_cluster"
) -> PipelineModel:
    """Fill, scale and assign the nearest centroid as one SQL stage.

    Plain arithmetic on columns: it stays inside generated code, saves and loads
    like any pipeline, and runs on streams. The lower cluster wins a tie.
    """
    parts = zip(scaling.features, scaling.fill, scaling.mean, scaling.scale, strict=True)
    columns = ", ".join(
        f"(coalesce(try_cast(`{f}` AS DOUBLE), {fill!r}D) - {mean!r}D) / {scale!r}D AS `_z{i}`"
        for i, (f, fill, mean, scale) in enumerate(parts)
    )
    distances = ", ".join(
        " + ".join(f"(`_z{i}` - {x!r}D) * (`_z{i}` - {x!r}D)" for i, x in enumerate(map(float, centre)))
        + f" AS `_d{k}`"
        for k, centre in enumerate(centroids)
    )
    z = ", ".join(f"`_z{i}`" for i in range(len(scaling.features)))
    d = [f"`_d{k}`" for k in range(len(centroids))]
    least = f"least({', '.join(d)})" if len(d) > 1 else d[0]
    nearest = " ".join(f"WHEN {name} = {least} THEN {k}" for k, name in enumerate(d))
    statement = (
        f"SELECT * EXCEPT ({', '.join(d)}), CASE {nearest} END AS {output} FROM ("
        f"SELECT * EXCEPT ({z}), {distances} FROM ("
        f"SELECT *, {columns} FROM __THIS__))"
    )
    return PipelineModel([SQLTransformer(statement=statement)])


def cluster_profiles(
    states: DataFrame, labels: Sequence[str] = STATUS_NAMES, cluster: str = "cluster"
) -> DataFrame:
    """Means and size per cluster; status by rank of mean delay.

    The rank runs over the clusters (k rows), not over the data.
    """
    profiles = states.groupBy(cluster).agg(
        F.avg("avg_speed").alias("avg_speed"),
        F.avg("avg_delay_minutes").alias("avg_delay_minutes"),
        F.avg("vehicle_count").alias("vehicle_count"),
        F.count(F.lit(1)).alias("samples"),
    )
    by_delay = Window.orderBy(F.col("avg_delay_minutes").asc_nulls_last(), cluster)
    rank = F.least(F.row_number().over(by_delay), F.lit(len(labels)))
    return profiles.withColumn("status", F.element_at(F.array(*map(F.lit, labels)), rank))


def transition_counts(
    states: DataFrame,
    keys: Sequence[str] = tuple(ROUTE_KEYS),
    ts: str = "event_ts",
    horizon: str = f"{HORIZON_MINUTES} minutes",
    cluster: str = "cluster",
) -> DataFrame:
    """Pairs (state at t, state at t + horizon) counted by cluster pair.

    Rows of one series, time and cluster are counted before the join and the
    counts multiplied, so copies never produce pairs.
    """
    instants = states.groupBy(*keys, ts, cluster).agg(F.count(F.lit(1)).alias("_n"))
    later = instants.select(
        *keys,
        (F.col(ts) - F.expr(f"INTERVAL {horizon}")).alias(ts),
        F.col(cluster).alias("next_cluster"),
        F.col("_n").alias("_m"),
    )
    return (
        instants.join(later, [*keys, ts])
        .groupBy(cluster, "next_cluster")
        .agg(F.sum(F.col("_n") * F.col("_m")).alias("pairs"))
    )


def transition_map(counts: DataFrame, k: int = CLUSTERS, cluster: str = "cluster") -> DataFrame:
    """Most frequent next cluster of every cluster 0..k-1.

    The lower next cluster wins a tie; a cluster without pairs maps to itself.
    """
    order = Window.partitionBy(cluster).orderBy(F.desc("pairs"), F.asc("next_cluster"))
    best = (
        counts.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .select(F.col(cluster).cast("int").alias(cluster), F.col("next_cluster").cast("int").alias("_next"))
    )
    every = counts.sparkSession.range(k).select(F.col("id").cast("int").alias(cluster))
    return every.join(best, cluster, "left").select(
        cluster, F.coalesce("_next", cluster).alias("next_cluster")
    )


@dataclass(frozen=True)
class StateModel:
    """A fitted pipeline with its two lookup tables (k rows each)."""

    pipeline: PipelineModel
    transitions: Mapping[int, int]
    profiles: Mapping[int, Mapping]
    metrics: Mapping[str, float] = field(default_factory=dict)
    params: Mapping[str, object] = field(default_factory=dict)

    def lookup(self, spark) -> DataFrame:
        """cluster → predicted cluster and the profile of the prediction."""
        rows = []
        for cluster, following in sorted(self.transitions.items()):
            p = self.profiles.get(following, {})
            rows.append(
                (cluster, following, p.get("status"), p.get("avg_speed"), p.get("avg_delay_minutes"))
            )
        return spark.createDataFrame(
            rows,
            "current_cluster int, predicted_cluster int, traffic_status string, "
            "expected_avg_speed double, expected_avg_delay_minutes double",
        )


def fit_states(
    training: DataFrame,
    features: Sequence[str] = tuple(MODEL_FEATURES),
    k: int = CLUSTERS,
    seed: int = SEED,
    restarts: int = RESTARTS,
    horizon: str = f"{HORIZON_MINUTES} minutes",
    min_rows: int | None = None,
    stored: bool = False,
) -> tuple[StateModel, DataFrame]:
    """Fit the clusters; returns the model and the training rows with ``cluster``.

    The best of ``restarts`` seeds by training cost is kept; all share the passes over
    the rows. Raises when there are fewer rows than clusters or no pair of states at the
    horizon. ``stored`` says that ``training`` is read from a table.
    """
    rows = require_rows(training, max(k, min_rows or k), "training rows")
    scaling = learn_scaling(training, features, stored)
    z = scaled(training, scaling)
    points = training.select(F.array(*z.values()).alias("point"))
    # The upstream plan may end in few partitions, or in large ones.
    largest = points.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    blocks = kmeans.packed(kmeans.spread(points, len(z), rows, largest))
    try:
        best = kmeans.fit(blocks, len(z), k, [seed + i for i in range(restarts)])
        metrics = {"inertia": best.cost}
        if rows > k and sum(n > 0 for n in best.sizes) > 1:
            found = silhouette(kmeans.assigned(blocks, best.centres))
            metrics["silhouette_score"], metrics["silhouette_error"] = found
    finally:
        blocks.unpersist()
    pipeline = state_pipeline(scaling, best.centres.tolist())
    states = pipeline.transform(training).withColumnRenamed("current_cluster", "cluster")
    # k * k counts and k profiles at most.
    counts = transition_counts(states, horizon=horizon).collect()
    if not counts:
        raise NotEnoughRows(f"no pair of states {horizon} apart")
    metrics["transition_rows"] = float(sum(r["pairs"] for r in counts))
    mapping = transition_map(
        states.sparkSession.createDataFrame(counts, "cluster int, next_cluster int, pairs long"), k
    ).collect()
    profiles = cluster_profiles(states).collect()
    model = StateModel(
        pipeline,
        {r["cluster"]: r["next_cluster"] for r in mapping},
        {r["cluster"]: {c: v for c, v in r.asDict().items() if c != "cluster"} for r in profiles},
        metrics,
        {"n_clusters": k, "feature_count": len(features), "training_rows": rows,
         "empty_features": ",".join(scaling.empty)},
    )
    return model, states
