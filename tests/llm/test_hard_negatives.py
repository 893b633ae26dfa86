"""Hard negatives against a brute-force search, and the tree bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadstate.llm import hard_negatives as hn

COLUMNS = "vec_id long, label int, vector array<long>, anchor string, row_id long, score double"


def brute(rows, k=5, j=5, low=80, high=100):
    size = max((len(r[2]) for r in rows if r[2] is not None), default=0)
    rows = [(i, y, v + [0] * (size - len(v))) for i, y, v in rows if y is not None and v is not None and None not in v]
    out = []
    for a, label, vector in rows:
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v, strict=True)), i is None, i, y) for i, y, v in rows if i is None or i != a]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for p in [s for s in scored if s[3] == label][:k]:
            inside = [s for s in scored if s[3] != label and low * -p[0] <= high * -s[0] <= high * -p[0]][:j]
            out += [(a, p[2], rank, s[2], -p[0], -s[0]) for rank, s in enumerate(inside, 1)]
    return sorted(out, key=repr)


def found(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], COLUMNS).repartition(3)
    result = hn.hard_negatives(table, F.col("vec_id") % 100 == 0, **more)
    return sorted((tuple(r) for r in result.collect()), key=repr)


def planted(seed, n, dim=8, spread=40):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (6, dim))
    rows = []
    for i in range(n):
        centre = centres[rng.integers(6)]
        rows.append((i, int(rng.integers(4)), (centre + rng.integers(-spread, spread, dim)).tolist()))
    return rows


@pytest.mark.parametrize("block,spread", [(2048, 40), (3, 2), (1, 10)])
def test_equals_brute_force(spark, block, spread):
    rows = planted(1, 900, spread=spread)
    rows += [(5000 + i, i % 4, rows[7][2]) for i in range(300)]  # copies of one vector
    assert found(spark, rows, block=block) == brute(rows)


def test_edges(spark):
    rows = [
        (0, 1, [1, 2]), (100, 1, [2]), (200, None, [1, 2]), (300, 1, None), (400, 1, [1, None]), (500, 2, []),
        (-100, 2, [3, 3]), (None, 1, [1, 2]), (None, 2, [1, 1]), (1, 2, [0, 2]), (2, 1, [-5, -5]), (3, 2, [2, 1]),
        (0, 1, [1, 2]), (4, 2, [2, 1]), (4, 2, [2, 1]), (700, 3, [9, 9]), (800, 4, [0, 0]), (5, 4, [-1, 0]),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, positives=1, negatives=2, low=50, block=2) == brute(rows, 1, 2, 50)
    assert found(spark, []) == []
    assert found(spark, [(1, 1, [1]), (2, 2, [1])]) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i * 25, int(i % 3), [int(x) for x in rng.integers(10**8, 10**9, 5)]) for i in range(60)]
    assert found(spark, rows) == brute(rows)


def test_bounds_hold_and_prune():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    centre = rng.integers(-200, 200, 16)
    rows = [(i, i % 3, (centre + rng.integers(-3, 4, 16)).tolist()) for i in range(40)]
    anchors = hn.anchors_of(rows, 16)
    assert (anchors.parents[1:] < np.arange(1, 40)).all()
    others = rng.integers(-200, 200, (500, 16))
    b = pa.record_batch(
        [pa.array(range(500)), pa.array([0] * 500, pa.int64()), pa.array(others.tolist(), pa.list_(pa.int64()))], ["i", "l", "v"]
    )
    c = hn.Candidates(b, 16)
    exact = others @ anchors.vectors.T
    least = np.quantile(exact, 0.99, axis=0)
    rescored = 0

    def wanted(a, low, high):
        assert (low <= exact[:, a] + 1e-6).all() and (high >= exact[:, a] - 1e-6).all()
        return high >= least[a]

    for a, picked, scores in hn.walk(c, anchors, wanted):
        assert (scores == exact[picked, a]).all()
        rescored += len(picked)
    assert rescored < 500 * 40 // 4
