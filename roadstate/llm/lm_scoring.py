"""Log-bilinear language model, trained with noise-contrastive estimation.

Counts of every word of the training rows are exact: map tasks count, one shuffle adds
up, the table is written to the shared folder. The network works on symbols: the most
frequent words, twice the square root of the vocabulary unless `words` says otherwise,
and one symbol per suffix class for all other words. A word of a class takes its share of
the class by its exact count (plus 0.1, with one slot for unknown words), so the model is
normalised over all words.

The score of a symbol is q(context) . r(symbol) + bias, with q the sum of one matrix per
position times the embeddings of the words before. Symbols are dealt to groups of equal
unigram mass, and a second table scores the groups: the probability of a symbol is that
of its group times its own within the group. Both tables are trained by contrasting each
target with noise from the unigram distribution; scoring normalises over the groups and
over the group of the target with one matrix product per batch of tokens, so its cost
grows with the square root of the number of symbols.

* The network learns from every block of the training text, unless a caller asks for a
  smaller `share` of them (`least_tokens` at least). Tasks train on their blocks, each from
  the same start, and a grouped sum averages what they have learned, weighted by tokens, for
  `rounds` rounds of different blocks; a hash deals the blocks to the rounds.
* Counts of the `table_words` most frequent words go to the workers; the words beyond
  leave the scoring pass as (document, word, number), already summed per document, and
  are joined with the count table.

Defined results: a null text is empty: one end token; a null id counts as empty text in
the fold; rows repeated with one id are scored one by one; without training rows every
word is unknown; of words with equal counts the smaller ones in byte order come first;
other columns are not read.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstate.llm.common import batches, fold, text_or_empty, tuples, written

END = b""  # words are never empty, so this is free for the end token
SUFFIX = 3  # bytes
CONTEXT = 4
PRIOR = 0.1


def tokens(text: bytes) -> list[bytes]:
    """Words (ASCII white space apart, A-Z lower-cased), then the end token."""
    words = text.lower().split()
    words.append(END)
    return words


def suffix_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-SUFFIX:]) % classes


def count_words(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task, flushed when the table grows."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    counts: Counter[bytes] = Counter()

    def flushed() -> Iterator[pa.RecordBatch]:
        words, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        for at in range(0, len(words), 50_000):
            some = slice(at, at + 50_000)
            yield pa.record_batch([pa.array(words[some], pa.binary()), pa.array(n[some])], schema=schema)

    for b in incoming:
        for text in b.column(0):
            counts.update(tokens(text.as_py()))
            if len(counts) > 400_000:
                yield from flushed()
                counts.clear()
    yield from flushed()


def groups_of(unigram: np.ndarray) -> np.ndarray:
    """Group of every symbol: about the square root of their number, of about equal mass."""
    size = len(unigram)
    wanted = max(1, math.isqrt(size))
    order = np.argsort(-unigram, kind="stable")
    before = np.cumsum(unigram[order]) - unigram[order]
    # Half of the cut goes by mass and half by number, so no group of rare symbols gets long.
    place = (before / max(unigram.sum(), 1e-300) + np.arange(size) / max(size, 1)) / 2
    raw = np.minimum((place * wanted).astype(np.int64), wanted - 1)
    found = np.empty(size, np.int64)
    found[order] = np.unique(raw, return_inverse=True)[1]
    return found


def summed(columns: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums of the columns (one row of `columns` each) by place, of `size` places."""
    out = np.empty((size, len(columns)), np.float32)
    for k, column in enumerate(columns):
        out[:, k] = np.bincount(at, column, size)
    return out


@dataclass
class Outputs:
    """Output tables with their biases as last columns; symbols stand group by group."""

    group: np.ndarray  # of every symbol
    place: np.ndarray  # row of every symbol in `symbols`
    starts: np.ndarray  # first row of every group, and the end
    symbols: np.ndarray
    groups: np.ndarray

    def __len__(self) -> int:
        return len(self.group)


class LogBilinear:
    """Symbols' embeddings, one matrix per context position, biases; the same for groups."""

    LEARNED = ("source", "target", "position", "bias", "group_target", "group_bias")

    def __init__(self, unigram: np.ndarray, dim: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = len(unigram)
        self.unigram = unigram / unigram.sum()
        self.group = groups_of(self.unigram)
        self.mass = np.bincount(self.group, self.unigram)
        self.source = rng.normal(0, 0.1, (size + 1, dim)).astype(np.float32)  # the last: before the text
        self.target = rng.normal(0, 0.1, (size, dim)).astype(np.float32)
        self.position = np.stack([np.eye(dim, dtype=np.float32) / CONTEXT for _ in range(CONTEXT)])
        self.bias = np.log(self.unigram).astype(np.float32)
        self.group_target = rng.normal(0, 0.1, (len(self.mass), dim)).astype(np.float32)
        self.group_bias = np.log(self.mass).astype(np.float32)
        self.sums = {n: np.full_like(getattr(self, n), 1e-6) for n in self.LEARNED}
        self.steps = 0

    @staticmethod
    def contexts(symbols: np.ndarray, start: int) -> np.ndarray:
        """The CONTEXT symbols before each position of one text."""
        padded = np.concatenate([np.full(CONTEXT, start, symbols.dtype), symbols])
        return np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[: len(symbols)]

    def contrast(self, h: np.ndarray, targets: np.ndarray, drawn: np.ndarray, table: str, bias: str, odds: np.ndarray, columns: np.ndarray):
        """Gradients of one output table and of h: targets against `drawn` noise."""
        out, b = getattr(self, table), getattr(self, bias)
        own, noise = out.take(targets, axis=0), out[drawn]
        right = np.einsum("ij,ij->i", h, own) + (b - odds)[targets]
        up = 1 - 1 / (1 + np.exp(-right.clip(-30, 30)))
        # The logistic function of the noise's scores, in place from their negatives.
        down = h @ -noise.T
        down += (odds - b)[drawn]
        np.clip(down, -30, 30, out=down)
        np.exp(down, out=down)
        down += 1
        np.reciprocal(down, out=down)
        columns = columns[:, : len(h)]
        np.multiply(h.T, up, out=columns)
        of_out = summed(columns, targets, len(out))
        of_bias = np.bincount(targets, up, len(b)).astype(np.float32)
        np.subtract.at(of_out, drawn, down.T @ h)
        np.subtract.at(of_bias, drawn, down.sum(0))
        return {table: of_out, bias: of_bias}, up[:, None] * own - down @ noise

    def train(self, contexts: np.ndarray, targets: np.ndarray, epochs: int = 2, noise: int = 64, rate: float = 0.08) -> None:
        """Noise-contrastive estimation with AdaGrad steps."""
        rng = np.random.default_rng((11, self.steps))
        odds = np.log(noise * self.unigram).astype(np.float32)
        group_odds = np.log(noise * self.mass).astype(np.float32)
        # Noise by binary search in the running sum: a draw costs the logarithm of the vocabulary.
        running, group_running = np.cumsum(self.unigram), np.cumsum(self.mass)
        contexts, targets = contexts.astype(np.intp), targets.astype(np.intp)
        step = 2048
        columns = np.empty((self.source.shape[1], CONTEXT * step))  # used again by every step
        for _ in range(epochs):
            order = rng.permutation(len(targets))
            for at in range(0, len(order), step):
                rows = order[at : at + step]
                ctx, t = contexts.take(rows, axis=0), targets[rows]
                n = len(rows)
                drawn = np.minimum(np.searchsorted(running, rng.random(noise)), len(running) - 1)
                drawn_groups = np.minimum(np.searchsorted(group_running, rng.random(noise)), len(group_running) - 1)
                inputs = self.source.take(ctx, axis=0).reshape(n, -1)
                h = inputs @ self.position.reshape(-1, self.position.shape[2])
                grads, gh = self.contrast(h, t, drawn, "target", "bias", odds, columns)
                more, of_groups = self.contrast(h, self.group[t], drawn_groups, "group_target", "group_bias", group_odds, columns)
                grads |= more
                gh = gh + of_groups
                grads["position"] = (inputs.T @ gh).reshape(self.position.shape)
                # One row per dimension: that of every context symbol, position by position.
                by_dim = self.position.transpose(1, 0, 2).reshape(-1, gh.shape[1]) @ gh.T
                columns[:, : CONTEXT * n] = by_dim.reshape(gh.shape[1], -1)
                grads["source"] = summed(columns[:, : CONTEXT * n], ctx.T.reshape(-1), len(self.source))
                self.steps += 1
                for name, g in grads.items():
                    g /= n
                    self.sums[name] += g * g
                    getattr(self, name)[...] += rate * g / np.sqrt(self.sums[name])

    def state(self) -> np.ndarray:
        """All that is learned, as one vector."""
        parts = [getattr(self, n) for n in self.LEARNED] + [self.sums[n] for n in self.LEARNED]
        return np.concatenate([p.reshape(-1) for p in parts]).astype(np.float32)

    def load(self, state: np.ndarray) -> None:
        at = 0
        for part in [getattr(self, n) for n in self.LEARNED] + [self.sums[n] for n in self.LEARNED]:
            part[...] = state[at : at + part.size].reshape(part.shape)
            at += part.size

    def freeze(self) -> tuple[np.ndarray, Outputs]:
        """Projected context tables, and the output tables."""
        projected = np.stack([self.source @ c for c in self.position]).astype(np.float32)
        order = np.argsort(self.group, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        starts = np.searchsorted(self.group[order], np.arange(len(self.mass) + 1))
        symbols = np.hstack([self.target, self.bias[:, None]]).astype(np.float32)[order]
        groups = np.hstack([self.group_target, self.group_bias[:, None]]).astype(np.float32)
        return projected, Outputs(self.group, place, starts, symbols, groups)


def chosen_log(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of the scores, at one column of each row."""
    np.clip(scores, -60, 60, out=scores)
    chosen = scores[np.arange(len(at)), at].astype(np.float64)
    np.exp(scores, out=scores)
    return chosen - np.log((scores @ np.ones(scores.shape[1], np.float32)).astype(np.float64))


def log_probabilities(projected: np.ndarray, output: Outputs, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Normalised natural log-probabilities of the targets.

    Targets are taken in the order of their groups, 65,536 at a time: a matrix product for
    the groups per 4096 of them, and one for the symbols of each group that is among these.
    """
    out = np.empty(len(targets), np.float64)
    for at in range(0, len(targets), 1 << 16):
        some = slice(at, at + (1 << 16))
        out[some] = log_slice(projected, output, contexts[some], targets[some])
    return out


def log_slice(projected: np.ndarray, output: Outputs, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
    group = output.group[targets]
    order = np.argsort(group, kind="stable")
    dim, own = projected.shape[2], group[order]
    h = np.ones((len(order), dim + 1), np.float32)
    logp = np.empty(len(order), np.float64)
    for at in range(0, len(order), 4096):
        ctx, part = contexts[order[at : at + 4096]], h[at : at + 4096]
        part[:, :dim] = projected[0][ctx[:, 0]]
        for j in range(1, CONTEXT):
            part[:, :dim] += projected[j][ctx[:, j]]
        logp[at : at + 4096] = chosen_log(part @ output.groups.T, own[at : at + 4096])
    places = output.place[targets[order]]
    ends = np.flatnonzero(np.append(own[1:] != own[:-1], len(own) > 0)) + 1
    start = 0
    for end in ends.tolist():
        first, last = output.starts[own[start]], output.starts[own[start] + 1]
        symbols = output.symbols[first:last].T
        for at in range(start, end, 4096):
            some = slice(at, min(at + 4096, end))
            logp[some] += chosen_log(h[some] @ symbols, places[some] - first)
        start = end
    out = np.empty(len(order), np.float64)
    out[order] = logp
    return out


@dataclass
class Model:
    """What a worker needs; its size is bounded by the parameters."""

    rank: dict[bytes, int]  # the most frequent words, most frequent first
    logs: np.ndarray  # log10(count + 0.1) of these
    symbol: np.ndarray  # their symbols
    share: np.ndarray  # log10 of their share of the symbol
    mass: np.ndarray  # log10 of the smoothed mass of each suffix class
    n_words: int  # symbols that are words
    projected: np.ndarray
    output: Outputs


def share_columns(counts: DataFrame, classes: int) -> DataFrame:
    """Counts and number of words per suffix class, over the whole count table."""
    suffix = F.when(F.octet_length("word") > SUFFIX, F.expr(f"substring(word, -{SUFFIX}, {SUFFIX})")).otherwise(F.col("word"))
    return counts.groupBy((F.crc32(suffix) % classes).alias("class")).agg(
        F.sum("n").alias("n"), F.count("*").alias("words")
    )


def word_counts(docs: DataFrame, text: Column) -> DataFrame:
    return written(
        docs.select(text.alias("text"))
        .mapInArrow(count_words, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "word-counts",
    )


def frequent(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """The `limit` most frequent words; of equal counts the smaller words first."""
    level = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(level.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    whole, total, cut = [], 0, None
    for row in steps:  # a few hundred rows: eighths of powers of two
        if total + row["words"] > limit:
            cut = row["step"]
            break
        total += row["words"]
        whole.append(row["step"])
    rows = counts.where(level >= min(whole)).collect() if whole else []
    if cut is not None and total < limit:
        rows += counts.where(level == cut).orderBy(F.desc("n"), "word").limit(limit - total).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda r: (-r[1], r[0]))


def symbols_of(words: list[bytes], rank: dict[bytes, int], symbol: np.ndarray, n_words: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank (-1: not in the table) and symbol of each word."""
    found = np.fromiter(map(rank.get, words, repeat(-1)), np.int32, len(words))
    syms = symbol[found] if len(symbol) else np.zeros(len(words), np.int32)
    rare = np.flatnonzero(found < 0)
    syms[rare] = [n_words + suffix_class(words[i], classes) for i in rare.tolist()]
    return found, syms


def training_blocks(model, share: float, classes: int, rounds: int, block: int = 64):
    """(round, symbols): symbol blocks for training, each with its context before it."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, start = model.value, len(model.value.output)
        limit = int(share * (1 << 32))
        schema = pa.schema([("round", pa.int32()), ("symbols", pa.binary())])

        def rows() -> Iterator[tuple]:
            for (text,) in tuples(incoming):
                _, syms = symbols_of(tokens(text), m.rank, m.symbol, m.n_words, classes)
                seed = zlib.crc32(text)
                padded = np.concatenate([np.full(CONTEXT, start), syms]).astype("<i4")
                for b, at in enumerate(range(0, len(syms), block)):
                    mark = zlib.crc32(b.to_bytes(8, "little"), seed)
                    if mark < limit:
                        yield mark % rounds, padded[at : at + block + CONTEXT].tobytes()

        return batches(rows(), schema)

    return run


#: Numbers of a learned vector in a row of the average; tokens that a task trains on at once.
SLICE, TRAIN_TOKENS = 64, 1 << 18


def cut(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and targets of all blocks."""
    symbols = np.frombuffer(b"".join(blocks), "<i4")
    length = np.fromiter(map(len, blocks), np.intp, len(blocks)) // 4 - CONTEXT
    at = np.arange(length.sum()) + CONTEXT * np.repeat(np.arange(1, len(blocks) + 1), length)
    return symbols[at[:, None] + np.arange(-CONTEXT, 0)], symbols[at]


def trained(net):
    """What a task's blocks teach: slices of the learned vector, with its tokens as weight."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: LogBilinear = pickle.loads(pickle.dumps(net.value))  # the shared start stays as it is
        blocks, held, total = [], 0, 0
        for b in incoming:
            for symbols in b.column(0).to_pylist():
                blocks.append(symbols)
                held += len(symbols) // 4 - CONTEXT
                if held >= TRAIN_TOKENS:
                    own.train(*cut(blocks), epochs=1)
                    blocks, held, total = [], 0, total + held
        if blocks:
            own.train(*cut(blocks), epochs=1)
            total += held
        if total:
            state = own.state()
            padded = np.append(state, np.zeros(-len(state) % SLICE, np.float32)).reshape(-1, SLICE)
            yield pa.record_batch(
                [
                    pa.array(np.arange(len(padded), dtype=np.int32)),
                    pa.array(np.full(len(padded), float(total))),
                    pa.FixedSizeListArray.from_arrays(pa.array(padded.reshape(-1)), SLICE).cast(pa.list_(pa.float32())),
                ],
                ["slice", "weight", "values"],
            )

    return run


def learn_rounds(net: LogBilinear, blocks: DataFrame, rounds: int) -> None:
    """Averages of what the tasks learn, round by round."""
    context = blocks.sparkSession.sparkContext
    for i in range(rounds):
        sent = context.broadcast(net)
        parts = blocks.where(F.col("round") == i).select("symbols").mapInArrow(
            trained(sent), "slice int, weight double, values array<float>"
        )
        sums = [F.sum(F.get("values", F.lit(j)) * F.col("weight")).alias(f"v{j}") for j in range(SLICE)]
        found = parts.groupBy("slice").agg(F.sum("weight").alias("weight"), *sums).collect()  # as many as the model has slices
        if found:
            found.sort(key=lambda r: r["slice"])
            values = np.array([r[2:] for r in found]) / np.array([r["weight"] for r in found])[:, None]
            net.load(values.reshape(-1).astype(np.float32))
            net.steps += 1
        sent.unpersist()


SCORED = "row_id long, n_tokens long, known long, base double, score double, rare array<struct<word:binary,n:long>>"
ARROW_SCORED = pa.schema(
    [
        ("row_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("known", pa.int64()),
        ("base", pa.float64()),
        ("score", pa.float64()),
        ("rare", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
    ]
)


def score_texts(model, classes: int, per_batch: int = 1 << 16):
    """Per document all terms but log10(count + 0.1) of its rare words, and these words."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        start = len(m.output)

        def scored(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            words = [w for t in texts for w in t]
            found, syms = symbols_of(words, m.rank, m.symbol, m.n_words, classes)
            lengths = np.array([len(t) for t in texts])
            ends = np.cumsum(lengths)
            begins = ends - lengths
            # All texts in one array, with the start of a text before each.
            place = np.arange(len(syms)) + CONTEXT * np.repeat(np.arange(1, len(texts) + 1), lengths)
            padded = np.full(len(syms) + CONTEXT * len(texts), start, np.intp)
            padded[place] = syms
            contexts = padded[place[:, None] + np.arange(-CONTEXT, 0)]
            logp = log_probabilities(m.projected, m.output, contexts, syms) / np.log(10)
            rare = found < 0
            known = ~rare
            base = np.where(known, m.logs[found] if len(m.logs) else 0.0, 0.0)
            logp[known] += m.share[found[known]]
            logp[rare] -= m.mass[syms[rare] - m.n_words]
            sums = [np.add.reduceat(v, begins) for v in (known.astype(np.int64), base, logp)]
            at = np.flatnonzero(rare)
            rare_words = [words[i] for i in at.tolist()]
            some, times, offsets = [], [], [0]
            for a, b in zip(np.searchsorted(at, begins).tolist(), np.searchsorted(at, ends).tolist(), strict=True):
                counted = Counter(rare_words[a:b])
                some += counted.keys()
                times += counted.values()
                offsets.append(len(some))
            pairs = pa.StructArray.from_arrays([pa.array(some, pa.binary()), pa.array(times, pa.int64())], ["word", "n"])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)
            columns = [pa.array(ids, pa.int64()), *map(pa.array, (lengths, *sums)), lists]
            return pa.record_batch(columns, schema=ARROW_SCORED)

        ids, texts, size = [], [], 0
        for row_id, text in tuples(incoming):
            ids.append(row_id)
            texts.append(tokens(text))
            size += len(texts[-1])
            if size >= per_batch:
                yield scored(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield scored(ids, texts)

    return run


@dataclass
class Learned:
    """A model with the count table it rests on."""

    model: Model
    counts: DataFrame
    classes: int
    n_train: int
    vocabulary: int
    least: float  # count of the rarest word that the model's table holds


def learn(
    train: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int | None = None,
    classes: int = 128,
    table_words: int = 150_000,
    share: float = 1.0,
    least_tokens: int = 2_000_000,
    rounds: int = 6,
) -> Learned:
    """Counts and network from all rows of `train`."""
    spark = train.sparkSession
    text = text_or_empty(text_col).cast("binary")
    counts = word_counts(train, text)
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, vocabulary = totals["n"] or 0, totals["v"]

    top = frequent(counts, table_words)
    n_words = min(max(384, 2 * math.isqrt(vocabulary)) if words is None else words, len(top))
    rank = {w: i for i, (w, _) in enumerate(top)}
    top_counts = np.array([n for _, n in top], np.float64)
    classed = np.array([suffix_class(w, classes) for w, _ in top], np.int64)
    symbol = np.where(np.arange(len(top)) < n_words, np.arange(len(top)), n_words + classed).astype(np.int32)
    mass, size = np.zeros(classes), np.zeros(classes)
    for row in share_columns(counts, classes).collect():  # one row per class
        mass[row["class"]], size[row["class"]] = row["n"], row["words"]
    np.subtract.at(mass, classed[:n_words], top_counts[:n_words])
    np.subtract.at(size, classed[:n_words], 1)
    smoothed = np.log10(mass + PRIOR * (size + 1))
    logs = np.log10(top_counts + PRIOR)
    portion = np.where(np.arange(len(top)) < n_words, 0.0, logs - smoothed[classed] if len(top) else 0.0)

    net = LogBilinear(np.concatenate([top_counts[:n_words], mass]) + 1.0)
    model = Model(rank, logs, symbol, portion, smoothed, n_words, *net.freeze())
    if n_train:
        part = min(1.0, max(share, least_tokens / n_train))
        rows_part = min(1.0, 4 * part)
        chosen = F.pmod(F.xxhash64(F.col(id_col), F.lit("lm")), F.lit(1 << 20)) < int(rows_part * (1 << 20)) + 1
        first = spark.sparkContext.broadcast(model)
        blocks = written(
            train.where(chosen)
            .select(text.alias("text"))
            .mapInArrow(training_blocks(first, part / rows_part, classes, rounds), "round int, symbols binary"),
            "training-blocks",
            by="round",
        )
        learn_rounds(net, blocks, rounds)
        model = Model(rank, logs, symbol, portion, smoothed, n_words, *net.freeze())
        first.unpersist()
    return Learned(model, counts, classes, n_train, vocabulary, float(top_counts[-1]) if top else math.inf)


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    words: int | None = None,
    classes: int = 128,
    table_words: int = 150_000,
    share: float = 1.0,
    least_tokens: int = 2_000_000,
    rounds: int = 6,
    learned: Learned | None = None,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, per row.

    Rows whose fold of `folds` is 0 are held out of training. `base_score` is the
    unigram log10 probability with prior 0.1, `score` that of the model (`learned` of
    other rows, where it is given).
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col).cast("binary")
    if learned is None:
        train = docs.where(fold(F.col(id_col), folds) != 0)
        learned = learn(train, id_col, text_col, words, classes, table_words, share, least_tokens, rounds)
    model, counts, classes = learned.model, learned.counts, learned.classes
    n_train, vocabulary, least = learned.n_train, learned.vocabulary, learned.least

    sent = spark.sparkContext.broadcast(model)
    scored = written(
        docs.select(F.col(id_col).cast("long").alias("row_id"), text.alias("text"))
        .mapInArrow(score_texts(sent, classes), SCORED)
        .withColumn("row", F.monotonically_increasing_id()),
        "scored-texts",
    )
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    counted = rare.join(counts.where(F.col("n") <= least), "word", "left")
    terms = counted.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + PRIOR)).alias("rare_log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rare_known"),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    spread = float(np.log10(n_train + PRIOR * (vocabulary + 1)))
    return (
        scored.drop("rare")
        .join(terms, "row", "left")
        .select(
            F.col("row_id").alias(id_col),
            (fold(F.col("row_id"), folds) == 0).alias("held_out"),
            "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(n_train).cast("long").alias("train_tokens"),
            (F.col("base") + rare_log - F.col("n_tokens") * spread).alias("base_score"),
            (F.col("score") + rare_log).alias("score"),
        )
    )
