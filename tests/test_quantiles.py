"""Exact medians under narrowing, against the sorted list."""

import random
import statistics

from roadstate.operators.quantiles import exact_medians


def check(spark, columns, **options):
    names = [f"c{i}" for i in range(len(columns))]
    rows = list(zip(*columns, strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    expected = {}
    for n, values in zip(names, columns, strict=True):
        real = [v for v in values if v is not None and v == v]
        expected[n] = statistics.median(real) if real else None
    assert exact_medians(df, names, **options) == expected


def test_medians(spark):
    rng = random.Random(5)
    n = 2001
    columns = [
        [rng.random() for _ in range(n)],
        [float(rng.randrange(5)) for _ in range(n)],
        [rng.choice([0.0, 100.0]) if rng.random() < 0.9 else rng.random() * 100 for _ in range(n)],
        [None] * n,
        [None if i % 3 else rng.gauss(0, 1) for i in range(n)],
        [float("nan") if i % 2 else float(i) for i in range(n)],
        [7.0] * n,
    ]
    check(spark, columns)
    check(spark, columns, buckets=5)
    check(spark, [c[:-1] for c in columns], buckets=2)


def test_tiny(spark):
    check(spark, [[1.0, 2.0], [None, 3.0]], buckets=2)


def test_many_magnitudes_and_infinities(spark):
    rng = random.Random(6)
    inf = float("inf")
    columns = [
        [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) for _ in range(500)],
        [rng.choice([-inf, inf, 0.0, -0.0, 5e-324, 1e308, -1e308]) for _ in range(500)],
        [1e308 if i % 2 else -1e308 for i in range(499)] + [None],
        [1.0 + i * 2.0**-52 for i in range(500)],
    ]
    for buckets in (256, 3):
        check(spark, columns, buckets=buckets)


def test_passes_and_entries_are_bounded(spark, monkeypatch):
    rows = [(10.0 ** (i % 600 - 300) * (1 + i / 7000),) for i in range(5000)]
    df = spark.createDataFrame(rows, "v double")
    collected = []
    kind, collect = type(df), type(df).collect
    monkeypatch.setattr(kind, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    assert exact_medians(df, ["v"], buckets=16)["v"] == statistics.median(r[0] for r in rows)
    assert len(collected) <= 2 + 64 // 4 and max(map(len, collected)) <= 2 * 16


def test_rows_of_a_stored_table_are_not_kept(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "table")
    spark.range(4001).selectExpr("CAST(id % 97 AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, id * 0.5D) AS b").write.parquet(at)
    table = spark.read.parquet(at)
    kept = []
    monkeypatch.setattr(type(table), "persist", lambda self, *level: kept.append(self) or self)
    found = exact_medians(table, ["a", "b"], stored=True)
    assert not kept
    assert found == exact_medians(table, ["a", "b"]) and len(kept) == 1
