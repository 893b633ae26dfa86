"""KMeans of many seeds: shared passes, the best of the fits, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadstate.operators import kmeans
from roadstate.operators.metrics import squared_distances
from roadstate.plans.registry import PLANTED, planted_states
from roadstate.operators.clusters import fit_states


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def fitted(spark, points, k, seeds):
    rows = spark.createDataFrame([([float(x) for x in p],) for p in points], "point array<double>").repartition(3)
    return kmeans.fit(kmeans.packed(rows), len(points[0]), k, seeds)


def test_restarts_share_their_passes(spark):
    rows = planted_states(spark, "/root/testdata/sf0.001").persist()
    used = []
    for restarts in (1, 10):
        before = jobs(spark)
        fit_states(rows, PLANTED, restarts=restarts)
        used.append(jobs(spark) - before)
    # More seeds may take a few more passes to settle, not ten times as many.
    assert used[1] <= used[0] + kmeans.MAX_ITERATIONS


def test_best_of_the_seeds(spark):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [9, 0], [0, 9], [9, 9]], float)
    points = np.concatenate([c + rng.normal(0, 0.3, (50, 2)) for c in centres])
    found = fitted(spark, points, 4, range(10))
    want = sum(np.square(p - p.mean(0)).sum() for p in np.split(points, 4))
    assert found.cost == pytest.approx(want) and found.sizes == [50] * 4


def test_fewer_different_rows_than_centres(spark):
    found = fitted(spark, [[1.0, 2.0]] * 5 + [[3.0, 4.0]] * 2, 3, [1, 2])
    assert sorted(found.sizes) == [2, 5] and found.cost == 0.0
    with pytest.raises(Exception, match="not a number"):
        fitted(spark, [[1.0], [float("nan")]], 1, [1])


def test_distances_of_close_rows_far_from_the_origin():
    rng = np.random.default_rng(3)
    left = np.concatenate([1e6 + rng.normal(0, 1e-4, (20, 5)), rng.normal(0, 1, (20, 5))])
    right = np.concatenate([left[:7], left[:9] + 1e-5, left[25:]])
    want = np.square(left[:, None] - right[None]).sum(2)
    assert np.allclose(squared_distances(left, right), want, rtol=1e-8, atol=0)


@pytest.mark.parametrize("width", [3, 35, 200])
def test_blocks_are_small_whatever_the_partition(spark, width):
    point = F.array(*[(F.col("id") * (i + 1)).cast("double") for i in range(width)])
    blocks = kmeans.packed(spark.range(0, 5000, 1, 1).select(point.alias("point")))
    sizes = [r[0] for r in blocks.select(F.length("block")).collect()]
    blocks.unpersist()
    # An Arrow batch has thousands of blocks; one block per batch of rows made it the partition.
    assert sum(sizes) == 5000 * width * 8 and max(sizes) <= max(kmeans.BLOCK_BYTES, width * 8)


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_rows_of_a_batch_of_blocks(kind):
    rows = np.arange(30_000.0).reshape(-1, 3)
    blocks = [part.tobytes() for part in np.split(rows, [1, 4, 6, 9000])]
    batch = pa.record_batch([pa.array(blocks, kind)], ["block"])
    assert np.array_equal(np.concatenate(list(kmeans._parts(iter([batch]), 3))), rows)
    assert np.array_equal(np.concatenate(list(kmeans._parts(iter([batch.slice(1, 3)]), 3))), rows[1:9000])
    assert max(map(len, kmeans._parts(iter([batch]), 3))) <= kmeans.AT_ONCE
    assert not list(kmeans._parts(iter([batch.slice(0, 0)]), 3))


def test_large_partitions_are_spread(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "PARTITION_BYTES", 1000 * 8 * 2)
    all_in_one = spark.range(0, 10_000, 1, 1).union(spark.range(0, 0, 1, 40))
    points = all_in_one.select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("point"))
    spread = kmeans.spread(points, 2, 10_000, 10_000)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 10 and max(sizes) < 1100
    small = spark.range(0, 8000, 1, 8).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("point"))
    assert kmeans.spread(small, 2, 8000, 1000) is small


def test_a_fit_spreads_large_partitions(spark, monkeypatch):
    taken = []
    packed = kmeans.packed

    def seen(points):
        taken.extend(r["count"] for r in points.groupBy(F.spark_partition_id()).count().collect())
        return packed(points)

    rows = planted_states(spark, "/root/testdata/sf0.001").repartition(5).persist()
    whole, _ = fit_states(rows, PLANTED, restarts=2)
    most = rows.count() // 20
    monkeypatch.setattr(kmeans, "PARTITION_BYTES", most * 8 * len(PLANTED))
    monkeypatch.setattr(kmeans, "packed", seen)
    cut, _ = fit_states(rows, PLANTED, restarts=2)
    rows.unpersist()
    assert len(taken) >= 20 and max(taken) <= 2 * most
    by_status = [{p["status"]: p["samples"] for p in m.profiles.values()} for m in (whole, cut)]
    assert by_status[0] == by_status[1] and cut.metrics["inertia"] == pytest.approx(whole.metrics["inertia"])
