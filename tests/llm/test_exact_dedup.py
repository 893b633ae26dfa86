import hashlib
import random

import pytest
from conftest import SF

from roadstate.llm.exact_dedup import PatriciaTrie, exact_dedup

from llm_fixtures import docs_of  # noqa: F401

LONG = "x" * 300_000 + "End"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if lower(u) == lower(t)]
        known = [j for j in same if j is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (1, "Abc"), (2, "aBC"), (3, "abcd"), (4, "ab"), (5, ""), (6, None), (7, "É"), (8, "é"), (9, LONG),
    (10, LONG.upper()), (11, LONG + "."), (3, "abcd"), (None, "abc"), (None, "alone"), (12, "abc "),
]


@pytest.mark.parametrize("memory", [96 << 20, 2000])
def test_equals_brute_force(docs_of, memory):
    got = exact_dedup(docs_of(ROWS), memory=memory)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ROWS)


def test_smallest_owner(docs_of):
    got = exact_dedup(docs_of([(1, "a"), (2, "A"), (3, "b")]), largest=False)
    assert sorted((r.doc_id, r.keep_id) for r in got.collect()) == [(1, 1), (2, 1), (3, 3)]


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("limit", [None, 3000, 600])
def test_trie_counts_like_a_table(limit):
    rng = random.Random(4)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(0, 9))) for _ in range(3000)]
    trie, want = PatriciaTrie(True, limit), {}
    for n, key in enumerate(keys):
        trie.insert(key, n)
        owner, rows = want.get(key, (0, 0))
        want[key] = (max(owner, n), rows + 1)
    found = list(trie.drain())
    assert len(found) == len(want) and {k: (o, n) for k, o, n in found} == want


def test_query_keeps_every_document(spark):
    from roadstate.llm.queries import QUERIES

    got = QUERIES["op3_exact_dedup"](spark, SF).toPandas()
    assert len(got) == 200 and (got.groupby("keep_id").kept.sum() == 1).all()
