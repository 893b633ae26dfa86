import random

import numpy as np
import pytest

from roadstate.llm import near_dedup as nd
from roadstate.llm.components import components

from llm_fixtures import docs_of  # noqa: F401


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    n = min(k, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    out = []
    for i, (row_id, _) in enumerate(rows):
        ids = [r for j, (r, _) in enumerate(rows) if find(j) == find(i) and r is not None]
        low = min(ids) if ids else None
        out.append((row_id, len(sets[i]), low, row_id == low))
    return sorted(out, key=repr)


def cases(copies=60):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = []
    for i in range(copies):  # near copies, some of them far apart
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    for i in range(100, 140):
        rows.append((i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 80)))))
    chain = [f"c{i}" for i in range(260)]
    for i in range(12):  # each is linked to the next one only
        rows.append((200 + i, " ".join(chain[5 * i : 5 * i + 130])))
    rows += [(300, ""), (301, None), (302, " \n"), (303, "Two words"), (304, "two WORDS"), (None, rows[0][1]), (5, rows[5][1])]
    rows += [(305, " ".join(base).upper()), (306, " ".join(base)), (307, " ".join(rng.choice(vocab) for _ in range(30_000)))]
    return rows


@pytest.mark.parametrize("k, percent, cell", [(3, 85, 256), (5, 80, 4)])
def test_equals_brute_force(docs_of, k, percent, cell):
    rows = cases()
    got = nd.near_dedup(docs_of(rows), k=k, percent=percent, cell=cell).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, k, percent)


def test_empty_table(docs_of):
    assert nd.near_dedup(docs_of([(1, "a")]).where("false")).count() == 0


def test_pruning_keeps_pairs_above_the_threshold():
    needs = nd.fewest_matches(85, 1e-6)
    assert list(needs) == sorted(needs) and 60 < needs[-1] < 0.85 * nd.HASHES
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 30, nd.HASHES).astype(np.uint32)
    many = np.where(rng.random((2000, nd.HASHES)) < 0.86, one, one + 1).astype(np.uint32)
    assert len(nd.survivors(one, many, 85, 1e-6)) == 2000
    assert len(nd.survivors(one, np.where(rng.random((500, nd.HASHES)) < 0.3, one, one + 1), 85, 1e-6)) == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 90), (90, 95), (7, 7)] + [(200, i) for i in range(201, 260)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(51)} | {90: 90, 95: 90, 100: 90} | {i: 200 for i in range(200, 260)}
    assert {r.node: r.root for r in got} == want
