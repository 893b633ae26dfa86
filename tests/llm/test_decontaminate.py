import random
import re

import pytest

from roadstate.llm.decontaminate import contamination

from llm_fixtures import docs_of  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            b = words(text)
            size = min(window, len(b))
            for s in range(len(b) - size + 1) if b else ():
                for at in range(len(w) - size + 1):
                    if w[at : at + size] == b[s : s + size]:
                        hit |= set(range(at, at + size))
                        ids.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def compare(spark, docs_of, docs, items, **more):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs_of(docs), benchmark, **more).collect()
    rows = [(r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in got]
    assert [r.n_items for r in got] == [len(r.items) for r in got]
    assert sorted(rows, key=repr) == brute(docs, items)


def cases():
    rng = random.Random(8)
    vocab = ["Alpha", "beta", "é", "12", "中", "g", "Delta"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, line(rng.choice([10, 11, 25, 40]))) for i in range(12)]
    items += [(20, "one two three"), (21, "SOLO"), (22, ""), (23, None), (None, line(14)), (3, items[3][1]), (30, line(9))]
    docs = []
    for i in range(40):
        text = line(rng.randint(0, 60))
        if i % 2:
            part = words(rng.choice(items)[1])
            cut = rng.randint(0, max(0, len(part) - 10))
            text += " -- " + ", ".join(part[cut : cut + rng.randint(8, 14)]) + ". " + line(5)
        docs.append((i, text))
    docs += [(None, items[0][1]), (50, None), (51, ""), (52, "a One, TWO\nthree solo solo"), (7, docs[7][1]), (7, "other")]
    docs.append((60, (items[1][1] + " ") * 2000))
    return docs, items


def test_equals_brute_force(spark, docs_of):
    docs, items = cases()
    compare(spark, docs_of, docs, items)


@pytest.mark.parametrize("block", [7])
def test_blocks_change_nothing(spark, docs_of, block):
    docs, items = cases()
    compare(spark, docs_of, docs[:12] + docs[-4:], items, block=block)


def test_empty_tables(spark, docs_of):
    docs, items = cases()
    compare(spark, docs_of, docs[:5], [])
    none = spark.createDataFrame(items, "item_id long, text string")
    assert contamination(docs_of(docs).where("false"), none).count() == 0
