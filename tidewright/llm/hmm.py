"""Hidden Markov language model over words.

Words are counted over all training texts. The most frequent ones are symbols of their own, the others share one
symbol and are told apart by their smoothed counts, so the model is a distribution over all texts. Baum-Welch
expectations are made in each partition, summed by Spark and turned into the next parameters; the likelihood of a
text is computed exactly by the scaled forward recursion over the whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright.llm.common import batch, map_batches, signed, stretches, word_hashes
from tidewright.session import materialise

#: The hash that stands for the end of a text.
END = np.int64(0x5E0D)
#: Words with a symbol of their own; symbols must fit 16 bits.
HEAD = 65_000
STATES, SPAN, MANY = 8, 64, 4096


@dataclass
class Words:
    """Counts of the training texts: all tokens, distinct tokens, and the most frequent ones in order of their hash."""

    tokens: int
    distinct: int
    head: np.ndarray
    counts: np.ndarray

    def log_base(self, counts):
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    @property
    def rest(self) -> float:
        """The base probability of all words without a symbol, unseen ones included."""
        rest = self.tokens - int(self.counts.sum()) + 0.5 * (self.distinct - len(self.head)) + 0.5
        return rest / (self.tokens + 0.5 * (self.distinct + 1))

    def base(self) -> np.ndarray:
        """The base probability of each symbol, that of the rest last."""
        return np.append(10.0 ** self.log_base(self.counts.astype(float)), self.rest)


@dataclass
class Model:
    start: np.ndarray
    usual: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def count_words(documents: DataFrame, chosen: Column, text: str = "text") -> DataFrame:
    """``(word, c)``: how often each word hash, and the end of a text, occurs in the rows ``chosen`` holds for.

    Counts are summed per stretch of text and per task before the shuffle.
    """
    rows = documents.where(chosen).select(F.col(f"`{text}`").alias("text"))

    def run(part: pa.RecordBatch):
        for a, b, data, places in stretches(part.column("text"), 1 << 23):
            found, c = np.unique(signed(word_hashes(data, places)[0]), return_counts=True)
            yield [np.append(found, END), np.append(c, b - a)]

    return map_batches(rows, run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def summarise(counts: DataFrame, head: int = HEAD) -> Words:
    """What the driver needs of a count table: two sums and the ``head`` most frequent words."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(head).toArrow()
    words, c = np.asarray(top.column("word"), np.int64), np.asarray(top.column("c"), np.int64)
    order = np.argsort(words)
    return Words(int(total[0]), int(total[1]), words[order], c[order])


def encode(documents: DataFrame, words: Words, chosen: Column, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row number, the kept columns, whether the row is for training, its symbols (16 bits each) and its rare words."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{k}`") for k in keep)).alias("kept"),
        F.coalesce(chosen, F.lit(False)).alias("learn"), F.col(f"`{text}`").alias("text"),
    )
    head, rest = words.head, len(words.head)

    def run(part: pa.RecordBatch):
        for a, b, data, places in stretches(part.column("text")):
            found, begin = word_hashes(data, places)
            found = np.insert(signed(found), begin[1:], END)
            begin = begin + np.arange(len(begin))
            at = np.minimum(np.searchsorted(head, found), max(rest - 1, 0))
            known = head[at] == found if rest else np.zeros(len(found), bool)
            symbols = np.where(known, at, rest).astype("<u2")
            rare = np.concatenate([[0], np.cumsum(~known)])[begin]
            odd = found[~known]
            yield [
                part.column("row").slice(a, b - a), part.column("kept").slice(a, b - a), part.column("learn").slice(a, b - a),
                [symbols[begin[i] : begin[i + 1]].tobytes() for i in range(b - a)],
                [odd[rare[i] : rare[i + 1]].tobytes() for i in range(b - a)],
            ]

    kind = rows.schema["kept"].dataType.simpleString()
    return map_batches(rows, run, f"row long, kept {kind}, learn boolean, symbols binary, rare binary")


def first_model(words: Words, states: int = STATES, seed: int = 11) -> Model:
    """States that stay with themselves more often than not and differ by chance."""
    random = np.random.Generator(np.random.PCG64(seed))
    emit = words.base() * random.lognormal(0, 0.7, (states, len(words.head) + 1))
    move = np.full((states, states), 0.3 / max(states - 1, 1)) + np.eye(states) * (0.7 - 0.3 / max(states - 1, 1))
    even = np.full(states, 1 / states)
    return Model(even, even, move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def _expect(model: Model, symbols: np.ndarray, begin: np.ndarray, first: np.ndarray, sums: dict) -> None:
    """Forward and backward over windows of at most ``SPAN`` symbols, longest first, and their expected counts."""
    k, m = model.emit.shape
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    size = np.diff(begin)
    order = np.argsort(-size, kind="stable")
    for lo in range(0, len(order), MANY):
        part = order[lo : lo + MANY]
        n, at, fresh = size[part], begin[:-1][part], first[part]
        steps = int(n[0])
        live = [int(np.searchsorted(-n, -t, "left")) for t in range(steps)]
        ids = [symbols[at[: live[t]] + t] for t in range(steps)]
        e = [np.take(emit, ids[t], axis=1) for t in range(steps)]
        alpha, scale = [], []
        a = np.where(fresh, model.start[:, None], model.usual[:, None]).astype(np.float32) * e[0]
        for t in range(steps):
            if t:
                a = (move.T @ alpha[-1][:, : live[t]]) * e[t]
            c = np.maximum(a.sum(0), 1e-30)
            alpha.append(a / c)
            scale.append(c)
            sums["log"] += float(np.log10(c, dtype=np.float64).sum())
        beta = np.ones((k, live[-1]), np.float32)
        gamma = [None] * steps
        gamma[-1] = alpha[-1]
        for t in range(steps - 2, -1, -1):
            ahead = e[t + 1] * beta / scale[t + 1]
            sums["move"] += alpha[t][:, : live[t + 1]].astype(np.float64) @ ahead.T.astype(np.float64) * model.move
            now = np.ones((k, live[t]), np.float32)
            now[:, : live[t + 1]] = move @ ahead
            gamma[t] = alpha[t] * now
            beta = now
        sums["start"] += gamma[0][:, fresh].sum(1, dtype=np.float64)
        flat, weight = np.concatenate(ids), np.concatenate(gamma, axis=1)
        sums["tokens"] += len(flat)
        for s in range(k):
            sums["emit"][s] += np.bincount(flat, weight[s], m)


def expectations(encoded: DataFrame, model: Model) -> DataFrame:
    """Expected counts of the rows to learn from, one row for each symbol and parameter, summed over all partitions.

    ``symbol`` from 0 on holds a symbol's expected uses by state; -1 the starts; -2 log10 likelihood and tokens; -10
    minus i the moves from state i. Texts are read in windows of ``SPAN`` symbols; one that does not begin a text begins
    with the usual shares of the states.
    """
    k, m = model.emit.shape
    schema = T.StructType([T.StructField("symbol", T.IntegerType()), *(T.StructField(f"w{s}", T.FloatType()) for s in range(max(k, 2)))])

    def run(parts):
        sums = {"emit": np.zeros((k, m)), "move": np.zeros((k, k)), "start": np.zeros(k), "log": 0.0, "tokens": 0}
        for part in parts:
            rows = part.column("symbols")
            lo = 0
            while lo < len(rows):
                texts, size = [], 0
                while lo < len(rows) and (not texts or size < 1 << 21):
                    texts.append(np.frombuffer(rows[lo].as_buffer(), "<u2"))
                    size += len(texts[-1]) * 2
                    lo += 1
                lengths = np.array([len(t) for t in texts])
                per = -(-lengths // SPAN)
                text_of = np.repeat(np.arange(len(texts)), per)
                inner = np.arange(len(text_of)) - np.repeat(np.cumsum(per) - per, per)
                starts = np.repeat(np.cumsum(lengths) - lengths, per) + inner * SPAN
                _expect(model, np.concatenate(texts).astype(np.int64), np.append(starts, lengths.sum()), inner == 0, sums)
        if sums["tokens"]:
            used = np.flatnonzero(sums["emit"].sum(0) > 0)
            symbol = np.concatenate([used, [-1, -2], -10 - np.arange(k)])
            values = np.concatenate([sums["emit"][:, used].T, sums["start"][None], np.zeros((1, k)), sums["move"]])
            values = np.pad(values, ((0, 0), (0, max(0, 2 - k))))
            values[len(used) + 1, :2] = sums["log"], sums["tokens"]
            yield batch(schema, [symbol, *values.T])

    rows = encoded.where("learn").select("symbols").mapInArrow(run, schema)
    return rows.groupBy("symbol").agg(*(F.sum(F.col(f"w{s}").cast("double")).alias(f"w{s}") for s in range(max(k, 2))))


def maximise(found: DataFrame, words: Words, model: Model, weight: float = 64.0) -> tuple[Model, float]:
    """The next parameters, each state's words smoothed with ``weight`` tokens of the base; log10 likelihood a token."""
    k, m = model.emit.shape
    rows = found.toArrow()
    symbol = np.asarray(rows.column("symbol"))
    values = np.stack([np.asarray(rows.column(f"w{s}")) for s in range(max(k, 2))], axis=1) if len(symbol) else np.zeros((0, max(k, 2)))
    if not len(symbol):
        return model, 0.0
    emit = np.zeros((k, m))
    emit[:, symbol[symbol >= 0]] = values[symbol >= 0, :k].T
    usual = emit.sum(1) + 1e-3
    emit = (emit + weight * words.base()) / (emit.sum(1, keepdims=True) + weight)
    move, start = np.full((k, k), 0.1), np.full(k, 0.1)
    for i in range(k):
        move[i] += values[symbol == -10 - i, :k].sum(0)
    start += values[symbol == -1, :k].sum(0)
    log, tokens = values[symbol == -2, :2].sum(0)
    emit /= emit.sum(1, keepdims=True)
    return Model(start / start.sum(), usual / usual.sum(), move / move.sum(1, keepdims=True), emit), log / max(tokens, 1)


def fit(encoded: DataFrame, words: Words, states: int = STATES, warm: int = 5, rounds: int = 2) -> Model:
    """Baum-Welch: ``warm`` rounds to part the states and ``rounds`` more, each over all training rows."""
    model = first_model(words, states)
    for _ in range(warm + rounds):
        model, _ = maximise(expectations(encoded, model), words, model)
    return model


def log_likelihood(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each symbol sequence, by the scaled forward recursion over all of it."""
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-size, kind="stable")
    out = np.zeros(len(texts))
    if not len(texts) or not size[order[0]]:
        return out
    symbols = np.concatenate([texts[i] for i in order]).astype(np.int64)
    n = size[order]
    at = np.cumsum(n) - n
    steps = int(n[0])
    live = np.searchsorted(-n, -np.arange(steps), "left")
    emit, move = np.ascontiguousarray(model.emit.T), model.move
    total = np.zeros(len(texts))
    a = np.repeat(model.start[None], live[0], 0)
    for t in range(steps):
        m = live[t]
        if t:
            a = a[:m] @ move
        a *= emit[symbols[at[:m] + t]]
        c = a.sum(1)
        a /= c[:, None]
        total[:m] += np.log10(c)
    out[order] = total
    return out


def score(encoded: DataFrame, words: Words, counts: DataFrame, model: Model) -> DataFrame:
    """``row``, the kept columns, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every text.

    Rare words are joined with the count table on the word, each once a text; the frequent ones never leave their text.
    """
    base, rest = words.log_base(words.counts.astype(float)), len(words.head)
    logs = np.append(base, 0.0)
    log_rest = math.log10(words.rest)

    def run(part: pa.RecordBatch):
        texts = [np.frombuffer(x.as_buffer(), "<u2") for x in part.column("symbols")]
        rare = [int((t == rest).sum()) for t in texts]
        yield [
            part.column("row"), part.column("kept"), [len(t) for t in texts], [len(t) - r for t, r in zip(texts, rare, strict=True)],
            [float(logs[t].sum()) for t in texts], log_likelihood(model, texts) - np.array(rare) * log_rest,
        ]

    kind = encoded.schema["kept"].dataType.simpleString()
    scored = map_batches(encoded.select("row", "kept", "symbols"), run, f"row long, kept {kind}, n_tokens long, known long, base double, hidden double")

    def spread(part: pa.RecordBatch):
        for row, words_of in zip(part.column("row").to_pylist(), part.column("rare"), strict=True):
            found, c = np.unique(np.frombuffer(words_of.as_buffer(), np.int64), return_counts=True)
            yield [np.full(len(found), row), found, c]

    def together(parts):
        held, size = [], 0
        for part in parts:
            for columns in spread(part):
                held.append(columns)
                size += len(columns[0])
                if size > 200_000:
                    yield batch(rare_schema, [np.concatenate(c) for c in zip(*held, strict=True)])
                    held, size = [], 0
        if held:
            yield batch(rare_schema, [np.concatenate(c) for c in zip(*held, strict=True)])

    rare_schema = T.StructType.fromDDL("row long, word long, n long")
    rare = encoded.where(F.length("rare") > 0).select("row", "rare").mapInArrow(together, rare_schema)
    logarithm = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(words.tokens + 0.5 * (words.distinct + 1)))
    rare = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * logarithm).alias("rare"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("seen")
    )
    nothing = F.lit(0.0)
    return scored.join(rare, "row", "left").select(
        "row", "kept", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare", nothing)).alias("base_score"), (F.col("hidden") + F.coalesce("rare", nothing)).alias("score"),
    )


def language_model(documents: DataFrame, chosen: Column, text: str = "text", keep: tuple[str, ...] = ("doc_id",), head: int = HEAD, **settings) -> DataFrame:
    """Learn from the rows ``chosen`` holds for and score every row; see :func:`score` for the columns.

    A null text is an empty one, whose only token is its end. A row of which ``chosen`` is null is scored and not
    learned from. Repeated rows count each time and stay. Without any training row the base and the model give every
    token probability 1, as unseen words are then all there is.
    """
    counts = materialise(count_words(documents, chosen, text), "words")
    words = summarise(counts, head)
    encoded = materialise(encode(documents, words, chosen, text, keep), "symbols")
    return score(encoded, words, counts, fit(encoded, words, **settings))
