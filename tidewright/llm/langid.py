"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a text from both sides, gives every byte a probability for each language, and the
document gets the mean over its bytes. It is trained in numpy by backpropagation through time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.llm.common import map_batches, stretches

UNKNOWN = "und"
#: Bytes whose windows are labelled together.
READ = 1 << 22


@dataclass
class Network:
    """Per direction: a row of gate inputs for each byte, the recurrent matrix and the bias of the candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]
    width: int
    span: int


def _initial(languages: int, width: int, random) -> dict[str, np.ndarray]:
    w = {}
    for side in "fb":
        w[f"x{side}"] = random.normal(0, 0.3, (2 * width, 256)).astype(np.float32)
        w[f"u{side}"] = random.normal(0, width**-0.5, (2 * width, width)).astype(np.float32)
        w[f"c{side}"] = np.zeros((width, 1), np.float32)
    w["out"] = random.normal(0, 0.3, (languages, 2 * width)).astype(np.float32)
    w["bias"] = np.zeros((languages, 1), np.float32)
    return w


def _sign(x, room):
    """``x / (1 + |x|)`` in place."""
    np.abs(x, out=room)
    room += 1.0
    x /= room


def _run(x, u, c, codes, order, keep=None):
    """Hidden states ``(steps, width, windows)`` of one direction; codes are ``(steps, windows)`` bytes.

    A minimal gated unit: one gate ``f`` both resets and updates, ``h' = h + f * (s(x + f * (U h + c)) - h)`` with the
    softsign ``s``, which costs a fraction of a tanh.
    """
    width, (steps, many) = u.shape[1], codes.shape
    states = np.empty((steps, width, many), np.float32)
    h = np.zeros((width, many), np.float32)
    gate, rec, room = np.empty((2 * width, many), np.float32), np.empty((2 * width, many), np.float32), np.empty((width, many), np.float32)
    f, cand, inner = gate[:width], gate[width:], rec[width:]
    for t in order:
        np.take(x, codes[t], axis=1, out=gate, mode="clip")
        np.matmul(u, h, out=rec)
        f += rec[:width]
        _sign(f, room)
        f += 1.0
        f *= 0.5
        inner += c
        np.multiply(f, inner, out=room)
        cand += room
        _sign(cand, room)
        if keep is not None:
            keep.append((t, h.copy(), gate.copy(), inner.copy()))
        now = states[t]
        np.subtract(cand, h, out=now)
        now *= f
        now += h
        h = now
    return states


def _back(u, keep, grad, codes):
    """Gradients of one direction from those of its hidden states, last step first."""
    width = u.shape[1]
    gu, gc, inputs = np.zeros_like(u), np.zeros((width, 1), np.float32), np.empty((len(keep), 2 * width, codes.shape[1]), np.float32)
    carry = np.zeros_like(keep[0][1])
    for t, h, gate, inner in reversed(keep):
        f, cand = gate[:width], gate[width:]
        d = grad[t] + carry
        dc = d * f * (1 - np.abs(cand)) ** 2
        df = (d * (cand - h) + dc * inner) * 0.5 * (1 - np.abs(2 * f - 1)) ** 2
        rec = np.concatenate([df, dc * f])
        gu += rec @ h.T
        gc += rec[width:].sum(1, keepdims=True)
        inputs[t, :width], inputs[t, width:] = df, dc
        carry = d * (1 - f) + u.T @ rec
    flat = codes.ravel()
    gx = np.stack([np.bincount(flat, inputs[:, j].ravel(), 256) for j in range(2 * width)])
    return gx.astype(np.float32), gu, gc


def train(samples: list[tuple[str, str]], width: int = 8, span: int = 128, steps: int = 320, many: int = 256, rate: float = 0.03, seed: int = 7) -> Network | None:
    """Fit a network to ``(language, text)`` pairs; ``None`` if there is no pair.

    The samples are cut into windows of ``span`` bytes. Each position of a window is a case to learn. ``steps`` batches of ``many`` windows are
    learned from, rounded up to whole passes over the samples.
    """
    languages = sorted({name for name, _ in samples})
    codes, labels = [], []
    for name, text in samples:
        raw = np.frombuffer(text.encode(), np.uint8)
        for at in range(0, len(raw), span):
            part = raw[at : at + span]
            if len(part) >= span // 4 or at == 0 and len(part):
                codes.append(np.resize(part, span))
                labels.append(languages.index(name))
    if not codes:
        return None
    random = np.random.Generator(np.random.PCG64(seed))
    w = _initial(len(languages), width, random)
    codes, labels = np.array(codes).T, np.array(labels)
    m1, m2, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(-(-steps // -(-len(labels) // many))):
        turn = random.permutation(len(labels))
        for at in range(0, len(turn), many):
            part = codes[:, turn[at : at + many]]
            seen = [[], []]
            hf = _run(w["xf"], w["uf"], w["cf"], part, range(span), seen[0])
            hb = _run(w["xb"], w["ub"], w["cb"], part, range(span - 1, -1, -1), seen[1])
            both = np.concatenate([hf, hb], axis=1)
            logits = np.matmul(w["out"], both) + w["bias"]
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[:, labels[turn[at : at + many]], np.arange(part.shape[1])] -= 1
            p /= part.size
            grads = {"out": np.einsum("tlb,thb->lh", p, both, optimize=True), "bias": p.sum((0, 2))[:, None]}
            dh = np.matmul(w["out"].T, p)
            for side, kept, d in (("f", seen[0], dh[:, :width]), ("b", seen[1], dh[:, width:])):
                grads[f"x{side}"], grads[f"u{side}"], grads[f"c{side}"] = _back(w[f"u{side}"], kept, d, part)
            step += 1
            pace = rate * max(1 - step / (steps + 1), 0.01) ** 0.5
            for k, g in grads.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                w[k] = (w[k] - pace * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Network(languages, w, width, span)


def _windows(network: Network, codes: np.ndarray) -> np.ndarray:
    """Probabilities ``(span, languages, windows)`` of every position of ``(span, windows)`` bytes."""
    w, width = network.weights, network.width
    hf = _run(w["xf"], w["uf"], w["cf"], codes, range(network.span))
    hb = _run(w["xb"], w["ub"], w["cb"], codes, range(network.span - 1, -1, -1))
    logits = np.matmul(w["out"][:, :width], hf) + np.matmul(w["out"][:, width:], hb) + w["bias"]
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def positions(network: Network, data: np.ndarray, places: np.ndarray, many: int = 2048, labels: bool = False):
    """For rows of bytes: the sum over positions of each language's probability and, with ``labels``, how many
    positions it wins.

    A row is read in windows of ``span`` bytes, both directions of a window starting afresh, so a text of any length
    takes bounded memory. The bytes after the end of a row's last window count for nothing.
    """
    span, kinds = network.span, len(network.languages)
    sizes = np.diff(places)
    per = -(-sizes // span)
    row = np.repeat(np.arange(len(sizes)), per)
    first = np.concatenate([[0], np.cumsum(per)])
    start = places[:-1][row] + (np.arange(len(row)) - first[row]) * span
    length = np.minimum(span, places[1:][row] - start)
    sums, wins = np.zeros((len(sizes), kinds)), np.zeros((len(sizes), kinds))
    for at in range(0, len(row), many):
        s, n = start[at : at + many], length[at : at + many]
        index = s[None, :] + np.arange(span)[:, None]
        live = np.arange(span)[:, None] < n[None, :]
        codes = np.where(live, data[np.minimum(index, len(data) - 1)], 0)
        p = _windows(network, codes)
        p *= live[:, None, :]
        best = p.argmax(1) if labels else None
        rows = row[at : at + many]
        total = p.sum(0, dtype=np.float64)
        for k in range(kinds):
            sums[:, k] += np.bincount(rows, total[k], len(sizes))
            if labels:
                wins[:, k] += np.bincount(rows, ((best == k) & live).sum(0), len(sizes))
    return sums, wins


def sample(documents: DataFrame, chosen: Column, per_language: int = 640, chars: int = 256, text: str = "text", lang: str = "lang", key: str = "doc_id") -> list[tuple[str, str]]:
    """A bounded sample of labelled stretches to fit the classifier on: at most ``per_language`` of ``chars`` characters.

    The rows of a language fall into ``per_language`` classes by a hash of their key, and the row with the smallest
    hash stands for its class. The stretch begins at a place the hash gives. The sample follows from the rows alone,
    however they are partitioned, and is put together before the shuffle, so a language with most rows costs the same.
    """
    rows = documents.where(chosen).where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").rlike("\\p{L}"))
    hashed = F.xxhash64(F.col(f"`{key}`"))
    place = F.pmod(hashed, F.greatest(F.length(f"`{text}`") - chars + 1, F.lit(1))).cast("int") + 1
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.pmod(hashed, F.lit(per_language)).alias("part"), F.xxhash64(hashed).alias("h"), F.substring(F.col(f"`{text}`"), place, F.lit(chars)).alias("stretch"))
    rows = rows.groupBy("lang", "part").agg(F.min_by("stretch", F.struct("h", "stretch")).alias("stretch"))
    return sorted((r.lang, r.stretch) for r in rows.collect())


def _labelled(documents: DataFrame, network: Network | None, text: str, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns as struct ``kept``, with ``lang_pred``, ``score`` and ``n_bytes``."""
    kept = F.struct(*(F.col(f"`{k}`") for k in keep))
    rows = documents.select(kept.alias("kept"), F.col(f"`{text}`").rlike("\\p{L}").alias("lettered"), *([] if text in keep else [F.col(f"`{text}`").alias("text")]))
    kind = rows.schema["kept"].dataType.simpleString()

    def label(part: pa.RecordBatch):
        texts = pc.struct_field(part.column("kept"), keep.index(text)) if text in keep else part.column("text")
        texts = pc.if_else(part.column("lettered"), texts, None)
        names, scores, sizes = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for a, b, data, places in stretches(texts, READ) if network is not None else ():
            sizes[a:b] = np.diff(places)
            some = sizes[a:b] > 0
            if some.any():
                sums, _ = positions(network, data, places)
                mean = sums / np.maximum(sizes[a:b, None], 1)
                best = mean.argmax(1)
                names[a:b][some] = np.array(network.languages, object)[best[some]]
                scores[a:b][some] = np.clip(mean[np.arange(b - a), best][some], 0, 1)
        yield [part.column("kept"), pa.array(names.tolist(), pa.string()), scores, sizes]

    return map_batches(rows, label, f"kept {kind}, lang_pred string, score double, n_bytes long")


def identify(documents: DataFrame, network: Network | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` (the pooled probability) and ``n_bytes`` of each whole text.

    Null, empty or letterless text is ``und`` with score 0 and no bytes, as is every text if nothing could be learned.
    Equal probabilities go to the first language by name. Rows are independent of each other, so repeated rows stay.
    """
    return _labelled(documents, network, text, keep).select("kept.*", "lang_pred", "score", "n_bytes")


def fit(documents: DataFrame, chosen: Column, **settings) -> Network | None:
    """Train on a bounded sample of the rows ``chosen`` holds for; see :func:`sample` and :func:`train`."""
    return train(sample(documents, chosen), **settings)


def with_language(documents: DataFrame, network: Network | None, least: float) -> DataFrame:
    """All columns of the documents the network can name a language for with at least ``least`` probability."""
    names = documents.columns
    found = _labelled(documents, network, "text", tuple(names)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return found.select(*(F.col("kept").getField(n).alias(n) for n in names))
