"""Euclidean silhouette against all pairs, exact and within its bound."""

import math

import numpy as np
import pytest

from roadstate.operators.metrics import silhouette


def brute(points, clusters):
    points, clusters = np.array(points), np.array(clusters)
    names = sorted(set(clusters))
    if len(names) < 2:
        return 0.0
    away = np.sqrt(np.square(points[:, None] - points[None]).sum(2))
    values = []
    for i, c in enumerate(clusters):
        same = (clusters == c) & (np.arange(len(points)) != i)
        if not same.any():
            values.append(0.0)
            continue
        a = away[i, same].mean()
        b = min(away[i, clusters == other].mean() for other in names if other != c)
        values.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(values))


def frame(spark, points, clusters):
    rows = [([float(x) for x in p], int(c)) for p, c in zip(points, clusters, strict=True)]
    return spark.createDataFrame(rows, "point array<double>, prediction int").repartition(3)


def planted(seed, n, spread):
    rng = np.random.default_rng(seed)
    clusters = rng.integers(0, 3, n)
    centres = np.array([[0, 0, 0, 0], [5, 0, 1, 0], [0, 6, 0, 2]], float)
    return centres[clusters] + rng.normal(0, spread, (n, 4)), clusters


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_exact_below_the_sample(spark, spread):
    points, clusters = planted(1, 300, spread)
    points = np.concatenate([points, points[:40], points[:1]])  # copies count with their number
    clusters = np.concatenate([clusters, clusters[:40], clusters[:1]])
    value, error = silhouette(frame(spark, points, clusters))
    assert error == 0.0 and value == pytest.approx(brute(points, clusters), abs=1e-9)


def test_sampled_within_the_bound(spark):
    points, clusters = planted(2, 1200, 2.0)
    want = brute(points, clusters)
    for seed in (1, 2, 3):
        value, error = silhouette(frame(spark, points, clusters), sample=200, seed=seed)
        assert 0 < error < math.sqrt(2 * math.log(200) / 120) and abs(value - want) <= error


def test_single_rows_and_single_clusters(spark):
    assert silhouette(frame(spark, [[0.0], [1.0]], [1, 1])) == (0.0, 0.0)
    value, _ = silhouette(frame(spark, [[0.0], [0.0], [4.0]], [0, 0, 5]))
    assert value == pytest.approx(2 / 3)
    assert silhouette(frame(spark, [[1.0], [1.0], [1.0], [1.0]], [0, 0, 1, 1])) == (0.0, 0.0)
