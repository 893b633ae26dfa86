"""Ranked lexical search against a brute-force ranking."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import LONG, docs_of  # noqa: F401

from roadstate.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(plain(t)), len(plain(t))) for i, t in docs]
    counts = [c for c in counts if c[2]]
    n_docs, total = len(counts), sum(c[2] for c in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c, n in counts:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in plain(text)
                if c[t]
            )
            scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        best = [s for s in scored if s[0] < 0][:k]
        out += [(item, rank, s[2], -s[0]) for rank, s in enumerate(best, 1)]
    return sorted(out, key=repr)


@pytest.fixture
def items_of(spark):
    def make(rows):
        full = [(i, t, 1, "x") for i, t in rows]
        return spark.createDataFrame(full, "item_id long, text string, rank int, row_id string")

    return make


def found(docs, items, **more):
    return sorted((tuple(r) for r in lexical_search.search(docs, items, **more).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(3000)] + ["Über", "日本", "a-b", "X9"]
    return [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]


@pytest.mark.parametrize("block,seeds", [(200_000, 64), (40, 16_384)])
def test_equals_brute_force(spark, docs_of, items_of, block, seeds):  # noqa: F811
    docs = corpus(1, 400)
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # many equal vectors
    items = [(i, t) for i, t in corpus(2, 25)]
    assert found(docs_of(docs), items_of(items), block=block, seed_docs=seeds) == brute(docs, items, 10)


def test_edges(spark, docs_of, items_of):  # noqa: F811
    long_term = "q" * 100_000
    docs = [
        (1, None), (2, ""), (3, "..,\x00"), (4, "CAT dog"), (5, "cat  DOG"), (5, "cat dog"), (None, "cat dog"),
        (6, LONG), (7, f"{long_term} cat"), (8, "É é cat"), (9, "bird"),
    ]
    items = [(1, None), (2, " "), (3, "cat cat dog"), (3, "cat cat dog"), (None, "w1 z3"), (4, long_term), (5, "é"), (6, "none")]
    assert found(docs_of(docs), items_of(items)) == brute(docs, items, 10)
    assert found(docs_of(docs), items_of(items), k=2, block=1) == brute(docs, items, 2)


def test_empty_tables(spark, docs_of, items_of):  # noqa: F811
    assert found(docs_of([]), items_of([(1, "cat")])) == []
    assert found(docs_of([(1, "cat")]), items_of([])) == []


def test_bounds_never_lose_a_row():
    rng = np.random.default_rng(5)
    import pyarrow as pa

    rows = []
    for i in range(300):
        terms = rng.choice(60, rng.integers(1, 20), replace=False).astype(np.int32)
        rows.append((i, terms, rng.integers(1, 10**6, len(terms))))
    lengths = [float(np.sqrt((v.astype(float) ** 2).sum())) for _, _, v in rows]
    b = pa.record_batch(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]), pa.array(lengths)],
        ["row_id", "terms", "values", "length"],
    )
    bucket = lexical_search.Bucket(b)
    pruned = 0
    for _ in range(40):
        terms = rng.choice(60, 8, replace=False).astype(np.int64)
        q = lexical_search.query(terms, rng.integers(1, 20_000, 8))
        weight = dict(zip(q.terms.tolist(), q.weights.tolist(), strict=True))
        exact = np.array([sum(weight.get(int(t), 0) * int(x) for t, x in zip(r[1], r[2], strict=True)) for r in rows])
        for least in (1, int(np.quantile(exact, 0.9)), int(exact.max()), int(exact.max()) * 2):
            kept = bucket.survivors(q, max(1, least))
            assert set(np.flatnonzero(exact >= max(1, least))) <= set(kept.tolist())
            assert (bucket.scores(q, kept) == exact[kept]).all() if len(kept) else True
            pruned += len(rows) - len(kept)
    assert pruned
