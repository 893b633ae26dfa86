import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from roadstate.llm import lm_scoring as lm
from roadstate.llm.common import fold_of

from llm_fixtures import docs_of  # noqa: F401


def brute(rows):
    toks = [((t or "").encode().lower().split() + [b""]) for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, toks, strict=True) if fold_of(i, 10) for w in ws)
    n, v = sum(c.values()), len(c)
    out = []
    for (i, _), ws in zip(rows, toks, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        out.append((i, fold_of(i, 10) == 0, len(ws), sum(w in c for w in ws), n, base))
    return sorted(out, key=repr)


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


ROWS = [(i, f"the cat {i % 3} sat on The mat") for i in range(40)] + [
    (50, ""), (51, None), (52, " \n\t"), (None, "the dog"), (3, "the cat"), (53, "É é\x85x  y"), (60, "unseen words only"),
    (61, "many " * 30_000),
]


@pytest.mark.parametrize("table_words", [150_000, 6, 0])
def test_base_equals_brute_force(docs_of, table_words):
    got = lm.lm_scores(docs_of(ROWS), words=4, classes=8, table_words=table_words, least_tokens=3000).collect()
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
    same(rows, brute(ROWS))
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_probabilities_add_up():
    rng = np.random.default_rng(2)
    net = lm.LogBilinear(rng.random(30) + 0.1, dim=5)
    net.train(rng.integers(0, 31, (4000, lm.CONTEXT)), rng.integers(0, 30, 4000), epochs=1)
    projected, output = net.freeze()
    context = np.repeat(rng.integers(0, 31, (1, lm.CONTEXT)), 30, axis=0)
    assert np.exp(lm.log_probabilities(projected, output, context, np.arange(30))).sum() == pytest.approx(1, abs=1e-5)


def test_training_learns_the_context():
    seq = np.tile(np.arange(8), 3000)
    net = lm.LogBilinear(np.ones(8), dim=8)
    contexts = lm.LogBilinear.contexts(seq, 8)
    net.train(contexts, seq, epochs=4)
    found = lm.log_probabilities(*net.freeze(), contexts[100:200], seq[100:200])
    assert np.exp(found).mean() > 0.6


def test_beats_the_unigram_on_held_out_rows(spark):
    from roadstate.llm.queries import QUERIES

    got = QUERIES["op1_lm_scoring"](spark, SF).toPandas()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    same(sorted(map(tuple, got[columns].itertuples(index=False)), key=repr), brute(docs))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_score_equals_brute_force(docs_of):
    """Every factor of every token, one by one."""
    docs = docs_of(ROWS)
    learned = lm.learn(docs, words=5, classes=4, table_words=9, least_tokens=2000, rounds=2)
    m, out = learned.model, learned.model.output
    counts = {bytes(r.word): r.n for r in learned.counts.collect()}
    classed = {}
    for w, n in counts.items():
        if m.rank.get(w, 99) >= m.n_words:
            mass, size = classed.get(lm.suffix_class(w, 4), (0, 0))
            classed[lm.suffix_class(w, 4)] = mass + n, size + 1

    def symbol(word):
        return m.rank[word] if m.rank.get(word, 99) < m.n_words else m.n_words + lm.suffix_class(word, 4)

    def probability(context, target):
        h = np.append(sum(m.projected[j][c].astype(float) for j, c in enumerate(context)), 1.0)
        groups = np.exp(out.groups.astype(float) @ h)
        inside = np.exp([out.symbols[out.place[s]].astype(float) @ h for s in range(len(out)) if out.group[s] == out.group[target]])
        own = np.exp(out.symbols[out.place[target]].astype(float) @ h)
        return groups[out.group[target]] / groups.sum() * own / inside.sum()

    def score(text):
        words = (text or "").encode().lower().split() + [b""]
        symbols, total = [len(out)] * lm.CONTEXT + [symbol(w) for w in words], 0.0
        for i, w in enumerate(words):
            total += math.log10(probability(symbols[i : i + lm.CONTEXT], symbols[i + lm.CONTEXT]))
            if symbols[i + lm.CONTEXT] >= m.n_words:
                mass, size = classed.get(symbols[i + lm.CONTEXT] - m.n_words, (0, 0))
                total += math.log10((counts.get(w, 0) + 0.1) / (mass + 0.1 * (size + 1)))
        return total

    short = [(i, t) for i, t in ROWS if len(t or "") < 1000]
    got = {(r.doc_id, r.n_tokens): r.score for r in lm.lm_scores(docs_of(short), learned=learned).collect()}
    for i, t in short:
        assert got[i, len((t or "").split()) + 1 if i != 53 else 4] == pytest.approx(score(t), rel=1e-4, abs=1e-4)


def test_all_words_have_probabilities_that_add_up():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 700):
        net = lm.LogBilinear(rng.random(size) ** 8 + 1e-9, dim=4)
        net.train(rng.integers(0, size + 1, (3000, lm.CONTEXT)), rng.integers(0, size, 3000), epochs=1)
        context = np.repeat(rng.integers(0, size + 1, (1, lm.CONTEXT)), size, axis=0)
        found = lm.log_probabilities(*net.freeze(), context, rng.permutation(size))
        assert np.exp(found).sum() == pytest.approx(1, abs=1e-5)
        assert np.bincount(net.group).max() <= 2 * math.isqrt(size) + 2


@pytest.mark.parametrize("limit", [1, 3, 50, 1000])
def test_ties_of_frequent_words_are_cut_by_word(spark, limit):
    words = [(f"w{i:03d}".encode(), 7 if i % 2 else 8) for i in range(100)] + [(b"top", 500)]
    counts = spark.createDataFrame(words, "word binary, n long").repartition(3)
    want = sorted(words, key=lambda r: (-r[1], r[0]))[:limit]
    assert lm.frequent(counts, limit) == want


def test_rounds_average_what_the_tasks_learn(spark):
    seq = np.tile(np.arange(8), 2000).astype("<i4")
    padded = np.concatenate([np.full(lm.CONTEXT, 8), seq]).astype("<i4")
    rows = [(i % 3, padded[at : at + 64 + lm.CONTEXT].tobytes()) for i, at in enumerate(range(0, len(seq), 64))]
    blocks = spark.createDataFrame(rows, "round int, symbols binary").repartition(4).cache()
    net, start = lm.LogBilinear(np.ones(8), dim=8), lm.LogBilinear(np.ones(8), dim=8)
    lm.learn_rounds(net, blocks, 3)
    contexts = lm.LogBilinear.contexts(seq, 8)[100:200]
    before, after = (lm.log_probabilities(*n.freeze(), contexts, seq[100:200]).mean() for n in (start, net))
    assert after > before + 0.5
    same_again = lm.LogBilinear(np.ones(8), dim=8)
    same_again.load(net.state())
    assert (same_again.state() == net.state()).all()


def test_empty_tables(docs_of):
    assert lm.lm_scores(docs_of(ROWS).where("false")).count() == 0
    held = [(i, "a b") for i in range(200) if fold_of(i, 10) == 0]
    same(
        sorted(
            (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
            for r in lm.lm_scores(docs_of(held), words=4, classes=8).collect()
        ),
        sorted(brute(held)),
    )


def test_network_learns_from_every_training_token(docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "learn_rounds", lambda net, blocks, rounds: seen.append(blocks.collect()))
    docs = docs_of([(i, f"word{i} " * (i % 90)) for i in range(300)])
    learned = lm.learn(docs, words=4, classes=8, least_tokens=0)
    assert sum(len(r["symbols"]) // 4 - lm.CONTEXT for r in seen[0]) == learned.n_train


def test_steps_equal_plain_gradients():
    """A step's sums by symbol are those of `np.add.at`, and rows of no gradient stay."""
    rng = np.random.default_rng(5)
    columns, at = rng.normal(size=(6, 500)), rng.integers(0, 40, 500)
    want = np.zeros((50, 6))
    np.add.at(want, at, columns.T)
    assert lm.summed(columns, at, 50) == pytest.approx(want, abs=1e-5)
    assert (lm.summed(columns, at, 50)[40:] == 0).all()


def test_probabilities_of_many_tokens_equal_those_of_few():
    """Slices and groups of any length: more tokens than are taken at once."""
    rng = np.random.default_rng(6)
    net = lm.LogBilinear(rng.random(60) ** 3 + 1e-6, dim=4)
    n = (1 << 16) + 5000
    contexts, targets = rng.integers(0, 61, (n, lm.CONTEXT)), rng.integers(0, 60, n)
    whole = lm.log_probabilities(*net.freeze(), contexts, targets)
    few = [lm.log_probabilities(*net.freeze(), contexts[a : a + 999], targets[a : a + 999]) for a in range(0, n, 999)]
    assert whole == pytest.approx(np.concatenate(few), abs=1e-5)
    assert len(lm.log_probabilities(*net.freeze(), contexts[:0], targets[:0])) == 0


def test_blocks_are_cut_at_once():
    """Blocks of any length give the contexts and targets of one text after the other."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 9, n).astype("<i4") for n in (64, 1, 7, 64, 30)]
    blocks = [np.concatenate([np.full(lm.CONTEXT, 9), t]).astype("<i4").tobytes() for t in texts]
    contexts, targets = lm.cut(blocks)
    assert (targets == np.concatenate(texts)).all()
    assert (contexts == np.concatenate([lm.LogBilinear.contexts(t, 9) for t in texts])).all()


def test_a_round_reads_its_own_blocks_only(docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "learn_rounds", lambda net, blocks, rounds: seen.append(blocks))
    lm.learn(docs_of([(i, f"word{i} " * (i % 90)) for i in range(300)]), words=4, classes=8, rounds=3)
    rows = seen[0].select("round", F.input_file_name().alias("file")).distinct().collect()
    assert len(rows) == len({r["file"] for r in rows}) and {r["round"] for r in rows} == {0, 1, 2}


def test_counts_of_a_task_are_flushed_whole():
    words = [b"w%d" % (i % 70_000) for i in range(90_000)]
    found = [b for b in lm.count_words(iter([pa.record_batch([pa.array([b" ".join(words)])], ["text"])]))]
    got = {w: n for b in found for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    assert got == Counter(words) + Counter([lm.END]) and max(b.num_rows for b in found) <= 50_000
