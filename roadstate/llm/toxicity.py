"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read as windows of `WINDOW` words, each overlapping the next by half; every
window is scored and a document has the score of its worst window. Word input: evidence
of the word and a learned hashed embedding. Character input: evidence of the word's
character n-grams (strongest and mean), so unseen forms of known stems count.

Training rows are a sample of the labelled ones, chosen by a hash: about `sample_docs`
toxic and twice as many clean ones are expected (a parameter). Evidence is a log-odds
z-score from their document frequencies, counted by one shuffle; at most `features` of
the strongest are kept (a parameter). The network is trained in numpy by
back-propagation through time. From each toxic document its windows with the most
evidence are positive, clean documents give negative windows.

Scoring projects the inputs of a word once, keeps them in a bounded table of the worker
and runs the recurrence over thousands of windows at a time.

Defined results: a null text is empty and gets the score of an empty window; a null id
counts as empty text in the fold and joins no label; rows repeated with one id are
scored one by one; a row with several labels trains with the largest; without labels of
both kinds every score is 0; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import batches, fold, give_back, release, text_or_empty, tuples, written

WINDOW, STRIDE = 48, 24
GRAMS = (3, 5)  # bytes
HIDDEN = 8
EMBED = 4
BUCKETS = 4096
EDGE = b".,;:!?\"'()[]{}<>*-_/\\|~`^&%$#@+="
TABLE = 300_000


def plain(token: bytes) -> bytes:
    return token.lower().strip(EDGE)


def grams(word: bytes) -> set[bytes]:
    """Character n-grams of a word, in UTF-8, with its edges marked."""
    chars = b"<" + word + b">"
    return {chars[i : i + n] for n in GRAMS for i in range(len(chars) - n + 1)}


def features_of(text: bytes) -> set[bytes]:
    """Words and, after a zero byte, character n-grams."""
    words = {plain(t) for t in set(text.split())} - {b""}
    parts = {g for w in words for g in grams(w)}
    return words | {b"\0" + g for g in parts}


class GramTable:
    """Evidence of character n-grams, looked up for many words at once.

    An n-gram is the number its bytes spell. A slot array leads from a hash of the
    number to one entry, and the entry's number decides, so nothing is mistaken. Numbers
    whose slot another one has go to a further slot array with a hash of its own, and so
    on until all have a place, so nothing is lost.
    """

    BITS = 20
    MULTIPLIER = 0x9E3779B97F4A7C15

    def __init__(self, weights: dict[bytes, float]):
        self.slots: dict[int, list[np.ndarray]] = {}
        self.keys, self.values = {}, {}
        for n in GRAMS:
            some = {int.from_bytes(k[1:], "little"): v for k, v in weights.items() if k[:1] == b"\0" and len(k) == n + 1}
            keys = np.array([0, *some], np.uint64)
            self.slots[n], left = [], np.arange(1, len(keys))
            while len(left) or not self.slots[n]:
                level = len(self.slots[n])
                slots = np.zeros(1 << self.BITS if not level else 1 << 12, np.int32)
                at = self.hash(keys[left], level)
                slots[at] = left
                self.slots[n].append(slots)
                left = left[slots[at] != left]
            self.keys[n] = keys
            self.values[n] = np.array([0.0, *some.values()], np.float32)

    def hash(self, keys: np.ndarray, level: int) -> np.ndarray:
        bits = self.BITS if not level else 12
        return (keys * np.uint64((self.MULTIPLIER * (2 * level + 1)) % (1 << 64))) >> np.uint64(64 - bits)

    def entries(self, n: int, numbers: np.ndarray) -> np.ndarray:
        """Entry of every number, 0 for numbers without one."""
        keys, found = self.keys[n], np.zeros(len(numbers), np.int32)
        for level, slots in enumerate(self.slots[n]):
            entry = slots[self.hash(numbers, level)]
            found = np.where(keys[entry] == numbers, entry, found)
        return found

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Strongest and mean evidence of each word's n-grams."""
        text = b"".join([b"<" + w + b">" for w in words])
        length = np.fromiter(map(len, words), np.int64, len(words)) + 2
        starts = np.cumsum(length) - length
        data = np.frombuffer(text, np.uint8).astype(np.uint64)
        left = np.repeat(starts + length, length) - np.arange(len(data))  # bytes to the end of the word
        high = np.zeros(len(words), np.float32)
        low = np.zeros(len(words), np.float32)
        total = np.zeros(len(words), np.float32)
        count = np.zeros(len(words), np.float32)
        for n in GRAMS:
            if len(data) < n:
                continue
            number = np.zeros(len(data) - n + 1, np.uint64)
            for j in range(n):
                number |= data[j : j + len(number)] << np.uint64(8 * j)
            entry = self.entries(n, number)
            entry[left[: len(number)] < n] = 0
            value = np.zeros(len(data), np.float32)
            value[: len(number)] = self.values[n][entry]
            high = np.maximum(high, np.maximum.reduceat(value, starts))
            low = np.minimum(low, np.minimum.reduceat(value, starts))
            total += np.add.reduceat(value, starts)
            count += np.maximum(length - n + 1, 0)
        strong = np.where(high >= -low, high, low)
        return strong, total / np.maximum(count, 1)


def count_features(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic documents, clean documents) of a task, flushed when it grows."""
    schema = pa.schema([("feature", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())])
    seen: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> Iterator[pa.RecordBatch]:
        yield from batches(((f, seen[1][f], seen[0][f]) for f in seen[1].keys() | seen[0].keys()), schema, 50_000)

    for text, toxic in tuples(incoming):
        seen[toxic].update(features_of(text))
        if len(seen[0]) + len(seen[1]) > 600_000:
            yield from flush()
            seen = (Counter(), Counter())
    yield from flush()


def evidence(docs: DataFrame, pos: int, neg: int, features: int) -> dict[bytes, float]:
    """z-scores of the strongest features over `pos` toxic and `neg` clean rows."""
    odds = F.log((F.col("toxic") + 0.5) / (pos + 1.0)) - F.log((F.col("clean") + 0.5) / (neg + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    scored = (
        docs.mapInArrow(count_features, "feature binary, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("toxic + clean >= 4")
        .select("feature", (odds / error).alias("z"))
        .where("abs(z) >= 2.75")
    )
    top = scored.orderBy(F.abs("z").desc(), "feature").limit(features).collect()
    return {bytes(r["feature"]): float(np.clip(r["z"], -8, 8)) for r in top}


@dataclass
class Network:
    """Weights; `params` has every array by name."""

    weights: dict[bytes, float]
    params: dict[str, np.ndarray] = field(default_factory=dict)
    trained: bool = False

    def __post_init__(self) -> None:
        self.table = GramTable(self.weights)

    def start(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        size = 3 + EMBED

        def near(*shape: int) -> np.ndarray:
            return (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)

        self.params = {
            "embed": near(BUCKETS, EMBED) * 4,
            "wf": near(size, 3 * HIDDEN),
            "wb": near(size, 3 * HIDDEN),
            "uf": near(HIDDEN, 3 * HIDDEN),
            "ub": near(HIDDEN, 3 * HIDDEN),
            "bf": np.zeros(3 * HIDDEN, np.float32),
            "bb": np.zeros(3 * HIDDEN, np.float32),
            "att": near(2 * HIDDEN, HIDDEN),
            "query": near(HIDDEN, 1)[:, 0],
            "out": near(2 * HIDDEN, 1)[:, 0],
            "bias": np.full(1, -2, np.float32),
        }

    def inputs(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word evidence, strongest and mean character evidence; hashes of the words."""
        words = [t.lower().strip(EDGE) for t in tokens]
        out = np.zeros((len(words), 3), np.float32)
        if words:
            get = self.weights.get
            out[:, 0] = [get(w, 0.0) / 4 for w in words]
            strong, mean = self.table.of_words(words)
            out[:, 1], out[:, 2] = strong / 4, mean / 2
        return out, np.array([zlib.crc32(w) % BUCKETS for w in words], np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def forward(p: dict[str, np.ndarray], xf: np.ndarray, xb: np.ndarray, mask: np.ndarray):
    """Logits of windows from projected inputs (steps, windows, 3 * HIDDEN), and the tape.

    The backward direction gets its inputs in reverse order of steps.
    """
    steps, n = mask.shape
    h = [np.zeros((n, HIDDEN), np.float32) for _ in range(2)]
    tape: list[list[tuple]] = [[], []]
    states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
    for t in range(steps):
        for d, (x, u) in enumerate(((xf[t], p["uf"]), (xb[t], p["ub"]))):
            at = t if d == 0 else steps - 1 - t
            m = mask[at][:, None]
            hu = h[d] @ u
            zr = sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = h[d] + m * (1 - z) * (c - h[d])
            tape[d].append((h[d], z, r, c, hu[:, 2 * HIDDEN :], m))
            h[d] = new
            states[at, :, d * HIDDEN : (d + 1) * HIDDEN] = new
    a = np.tanh(states @ p["att"])
    e = np.where(mask > 0, a @ p["query"], -1e9)
    e = np.exp(e - e.max(axis=0)) * mask
    alpha = e / np.maximum(e.sum(axis=0), 1e-9)
    pooled = (alpha[:, :, None] * states).sum(axis=0)
    return pooled @ p["out"] + p["bias"][0], (tape, states, a, alpha, pooled)


def gradients(p: dict[str, np.ndarray], x: np.ndarray, buckets: np.ndarray, mask: np.ndarray, y: np.ndarray):
    """Mean loss and its gradients by back-propagation through time."""
    steps, n = mask.shape
    full = np.concatenate([x, p["embed"][buckets]], axis=2)
    back = full[::-1]
    logit, (tape, states, a, alpha, pooled) = forward(p, full @ p["wf"] + p["bf"], back @ p["wb"] + p["bb"], mask)
    prob = sigmoid(logit)
    loss = -np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))
    g = {k: np.zeros_like(v) for k, v in p.items()}
    dl = ((prob - y) / n).astype(np.float32)
    g["bias"][0] = dl.sum()
    g["out"] = pooled.T @ dl
    dp = dl[:, None] * p["out"]
    dstates = alpha[:, :, None] * dp
    dalpha = (states * dp).sum(axis=2)
    de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
    g["query"] = (a * de[:, :, None]).sum(axis=(0, 1))
    da = de[:, :, None] * p["query"] * (1 - a * a)
    g["att"] = np.tensordot(states, da, ([0, 1], [0, 1]))
    dstates = dstates + da @ p["att"].T
    dfull = np.zeros_like(full)
    for d, (w, u, b) in enumerate((("wf", "uf", "bf"), ("wb", "ub", "bb"))):
        dh = np.zeros((n, HIDDEN), np.float32)
        for t in reversed(range(steps)):
            at = t if d == 0 else steps - 1 - t
            before, z, r, c, hu, m = tape[d][t]
            dh = dh + dstates[at, :, d * HIDDEN : (d + 1) * HIDDEN]
            dm = dh * m
            dc = dm * (1 - z) * (1 - c * c)
            dz = -dm * (c - before) * z * (1 - z)
            dr = dc * hu * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=1)
            du = np.concatenate([dz, dr, dc * r], axis=1)
            g[u] += before.T @ du
            g[w] += full[at].T @ dx
            g[b] += dx.sum(axis=0)
            dfull[at] += dx @ p[w].T
            dh = dh - dm * (1 - z) + du @ p[u].T
    np.add.at(g["embed"], buckets, dfull[:, :, 3:] * mask[:, :, None])
    return loss, g


def fit(net: Network, windows: list[list[bytes]], labels: np.ndarray, epochs: int = 6, rate: float = 0.02) -> None:
    """Adam over shuffled batches of windows."""
    net.start()
    rng = np.random.default_rng(3)
    words = list({w for some in windows for w in some})
    values, hashes = net.inputs(words)
    known = {w: i for i, w in enumerate(words)}
    x = np.zeros((len(windows), WINDOW, 3), np.float32)
    buckets = np.zeros((len(windows), WINDOW), np.int32)
    mask = np.zeros((len(windows), WINDOW), np.float32)
    for i, w in enumerate(windows):
        at = [known[token] for token in w]
        x[i, : len(w)], buckets[i, : len(w)], mask[i, : len(w)] = values[at], hashes[at], 1
    first = {k: np.zeros_like(v) for k, v in net.params.items()}
    second = {k: np.zeros_like(v) for k, v in net.params.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            _, g = gradients(
                net.params, x[rows].transpose(1, 0, 2), buckets[rows].T, mask[rows].T, labels[rows].astype(np.float32)
            )
            step += 1
            for k, v in g.items():
                v = np.clip(v, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                net.params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-6)
    net.trained = True


def windows_of(length: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover every word; an empty text has one empty window."""
    if length <= WINDOW:
        return [(0, length)]
    starts = list(range(0, length - WINDOW, STRIDE)) + [length - WINDOW]
    return [(s, s + WINDOW) for s in starts]


class Scorer:
    """Scores whole texts; projected inputs of words are kept in a bounded table."""

    def __init__(self, net: Network):
        if not net.params:
            net.start()
        self.net, p = net, net.params
        self.index: dict[bytes, int] = {}
        # Projected inputs of known words, one table per direction.
        self.tables = [np.zeros((1024, 3 * HIDDEN), np.float32) for _ in range(2)]

    def reset(self) -> None:
        """Forgets the words that came last; the earliest are mostly the frequent ones."""
        keep = TABLE // 3
        self.index = {t: i for t, i in self.index.items() if i < keep}
        self.tables = [t[:keep].copy() for t in self.tables]

    def rows_of(self, tokens: list[bytes]) -> np.ndarray:
        index = self.index
        new = list(set(tokens) - index.keys())
        if new:
            p = self.net.params
            values, hashes = self.net.inputs(new)
            x = np.concatenate([values, p["embed"][hashes]], axis=1)
            start, end = len(index), len(index) + len(new)
            for d, (w, b) in enumerate((("wf", "bf"), ("wb", "bb"))):
                if end > len(self.tables[d]):
                    # Rows beyond `end` are not written, so they take no memory yet.
                    grown = np.zeros((max(end, 2 * len(self.tables[d])), 3 * HIDDEN), np.float32)
                    grown[:start] = self.tables[d][:start]
                    self.tables[d] = grown
                self.tables[d][start:end] = x @ p[w] + p[b]
            index.update(zip(new, range(start, end), strict=True))
        return np.fromiter(map(index.__getitem__, tokens), np.int32, len(tokens))

    def logits(self, rows: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Logits of windows given as (start, end) into the rows of the tables.

        Windows lie along the last axis, so every gate is one contiguous block; the two
        directions are the first axis.
        """
        p, k = self.net.params, HIDDEN
        out = np.empty(len(spans), np.float32)
        u = np.stack([p["uf"].T, p["ub"].T]).copy()
        att = p["att"].T.copy()
        forth, back = self.tables
        for at in range(0, len(spans), 1024):
            part = spans[at : at + 1024]
            n, length = len(part), part[:, 1] - part[:, 0]
            steps = int(length.max(initial=0))
            mask = (np.arange(steps)[:, None] < length).astype(np.float32)
            full = bool(mask.all())
            where = np.minimum(part[:, 0] + np.arange(steps)[:, None], max(len(rows) - 1, 0))
            ids = rows[where] if len(rows) else np.zeros((steps, n), np.int32)
            h = np.zeros((2, k, n), np.float32)
            states = np.zeros((steps, 2, k, n), np.float32)
            x = np.empty((2, 3 * k, n), np.float32)
            for t in range(steps):
                x[0] = forth[ids[t]].T
                x[1] = back[ids[steps - 1 - t]].T
                hu = u @ h
                gates = x[:, : 2 * k]
                gates += hu[:, : 2 * k]
                np.negative(gates, out=gates)
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                c = hu[:, 2 * k :]
                c *= gates[:, k:]
                c += x[:, 2 * k :]
                np.tanh(c, out=c)
                c -= h
                z = gates[:, :k]
                np.subtract(1, z, out=z)
                c *= z
                if not full:
                    c[0] *= mask[t]
                    c[1] *= mask[steps - 1 - t]
                h += c
                states[t, 0] = h[0]
                states[steps - 1 - t, 1] = h[1]
            flat = states.reshape(steps, 2 * k, n)
            e = np.einsum("k,tkn->tn", p["query"], np.tanh(att @ flat))
            e = np.exp(e) * mask
            alpha = e / np.maximum(e.sum(axis=0), 1e-9)
            pooled = np.einsum("tn,tkn->kn", alpha, flat)
            out[at : at + n] = p["out"] @ pooled + p["bias"][0]
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of the worst window of each text."""
        if not self.net.trained:
            return np.zeros(len(texts))
        if len(self.index) > TABLE:
            self.reset()
        tokens = [t.split() for t in texts]
        rows = self.rows_of([w for t in tokens for w in t])
        spans, begins, base = [], [], 0
        for t in tokens:
            begins.append(len(spans))
            spans += [(base + a, base + b) for a, b in windows_of(len(t))]
            base += len(t)
        logits = self.logits(rows, np.array(spans, np.int64).reshape(-1, 2))
        return sigmoid(np.maximum.reduceat(logits, begins).astype(np.float64))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int, features: int, modulus: int, held: int, id_col: str, text_col: str) -> Network:
    """The network from the labelled rows outside the held-out fold."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & (fold(F.col("label_id"), modulus) != held))
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Network({})
    share = F.when(F.col("toxic") == 1, min(1.0, sample_docs / sizes[1])).otherwise(min(1.0, 2 * sample_docs / sizes[0]))
    pick = F.pmod(F.xxhash64("label_id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20)
    # The sample is drawn from the labels, so what is broadcast is bounded by it and no text is shuffled.
    chosen = written(
        docs.select(F.col(id_col).cast("long").alias("row_id"), text_or_empty(text_col).cast("binary").alias("text"))
        .join(F.broadcast(marks.where(pick)), F.col("row_id") == F.col("label_id"))
        .select("text", "toxic"),
        "toxicity-sample",
    )
    taken = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    if len(taken) < 2:
        return Network({})
    net = Network(evidence(chosen, taken[1], taken[0], features))
    rows = chosen.mapInArrow(training_windows(net), "words binary, toxic int").collect()  # four windows a row at most
    fit(net, Split(bytes(r["words"]) for r in rows), np.array([r["toxic"] for r in rows]))
    return net


class Split(list):
    """Texts that are split into words when they are looked at."""

    def __iter__(self) -> Iterator[list[bytes]]:
        return (text.split() for text in super().__iter__())


def training_windows(net: Network, each: int = 4):
    """Windows of a document with the most toxic evidence; for clean ones half by hash."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("words", pa.binary()), ("toxic", pa.int32())])

        def rows() -> Iterator[tuple]:
            for text, toxic in tuples(incoming):
                words = text.split()
                distinct = list(set(words))
                known = dict(zip(distinct, net.inputs(distinct)[0].sum(axis=1).tolist(), strict=True))
                strength = np.array([known[w] for w in words])
                spans = windows_of(len(words))
                peak = [float(np.maximum(strength[a:b], 0).max(initial=0)) for a, b in spans]
                best = sorted(range(len(spans)), key=lambda i: -peak[i])
                if toxic:
                    take = [i for i in best[:2] if peak[i] >= 0.6 * peak[best[0]]]
                else:
                    other = sorted(range(len(spans)), key=lambda i: zlib.crc32(b"%d" % i, len(words)))
                    take = list(dict.fromkeys(best[:2] + other[: each - 2]))
                for i in take:
                    yield b" ".join(words[slice(*spans[i])]), toxic

        return batches(rows(), schema, 512)

    return run


#: Characters of text that a task scores together.
AT_ONCE = 1 << 20


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 3,
    held: int = 1,
    threshold: float = 0.7,
    sample_docs: int = 3000,
    features: int = 10_000,
) -> DataFrame:
    """id, held_out, score, predicted, per row of `docs`.

    `labels` has doc_id and toxic; rows whose fold of `modulus` is `held` never train.
    Only the id and the text of a row pass through Python, and only the score comes back.
    """
    own = docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).alias("text"))
    net = train(own, labels, sample_docs, features, modulus, held, "row_id", "text")
    give_back()  # windows and gradients of the fit
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scorer = Scorer(sent.value)
        for b in incoming:
            sizes = b.column(2).to_numpy()
            at = 0
            while at < b.num_rows:
                # The row that passes the bound is still in: very long texts go alone.
                end = at + 1 + int(np.searchsorted(np.cumsum(sizes[at:]), AT_ONCE))
                part = b.slice(at, end - at)
                scores = scorer.scores(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(scores, pa.float64())], ["row_id", "score"])
                at = end
        del scorer
        give_back()  # the worker's next task may be another operator's

    text = text_or_empty("text").cast("binary")
    scored = own.select("row_id", text.alias("text"), F.octet_length(text).cast("long").alias("size")).mapInArrow(
        run, "row_id long, score double"
    )
    return scored.select(
        F.col("row_id").alias(id_col),
        (fold(F.col("row_id"), modulus) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
