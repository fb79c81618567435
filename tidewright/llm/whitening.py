"""Whitening of vectors on their leading principal components by spectrum slicing.

The number of positive pivots of an LDL' factorisation of ``V - s I`` is the number of eigenvalues above ``s``. Bisection on
these counts encloses the j-th largest eigenvalue alone, Rayleigh quotient iteration from inside the enclosure converges
cubically to its vector, and the counts on both sides of the quotient certify that it is number j.

Spark sums integers over all vectors; only matrices of the dimension of a vector reach the driver.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.common import map_batches
from tidewright.session import materialise

#: x = floor(SCALE * c) + SHIFT for an entry c; x is held within +-LIMIT.
SCALE, SHIFT, LIMIT = 1024.0, 100_000, 1 << 60
#: Rows that are multiplied at a time.
ROWS = 4096
_ALPHA = (1 + 17**0.5) / 8
_EPS = float(np.finfo(float).eps)


def integers(column: pa.Array, dimension: int | None = None) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Of each length of vector, its rows and their integer entries; null vectors and those with null or non-finite entries are left out."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    fine = (lengths > 0) & (bad[begin[1:]] == bad[begin[:-1]])
    out = []
    for d in np.unique(lengths[fine]) if dimension is None else [dimension]:
        rows = np.flatnonzero(fine & (lengths == d))
        entries = np.floor(SCALE * values[begin[rows][:, None] + np.arange(d)])
        out.append((rows, np.clip(entries, -LIMIT, LIMIT).astype(np.int64) + SHIFT))
    return out


def positive_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above zero: pivots of LDL' with blocks of one or two (Bunch and Kaufman)."""
    a, n = a.copy(), len(a)
    i = count = 0
    while i < n:
        size, own = 1, abs(a[i, i])
        if i + 1 < n:
            below = np.abs(a[i + 1 :, i])
            r = i + 1 + int(below.argmax())
            most = below[r - i - 1]
            if own < _ALPHA * most:
                row = np.abs(a[i:, r])
                row[r - i] = 0
                other = row.max()
                if own * other < _ALPHA * most * most:
                    to = i
                    if abs(a[r, r]) < _ALPHA * other:
                        size, to = 2, i + 1
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        block, rest = a[i : i + size, i : i + size], a[i + size :, i : i + size]
        if size == 2:
            count += 1  # such a block has a negative determinant: one pivot of each sign
            a[i + 2 :, i + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        elif block[0, 0]:
            count += int(block[0, 0] > 0)
            a[i + 1 :, i + 1 :] -= np.outer(rest[:, 0] / block[0, 0], rest[:, 0])
        i += size
    return count


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a positive semi-definite matrix, falling, and their unit vectors as columns."""
    n = len(v)
    one, top = np.eye(n), float(np.trace(v))
    if not top > 0:
        return np.zeros(k), one[:, :k]
    least = n * _EPS * top
    counts = {-least: n, top * 1.0625: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = positive_pivots(v - s * one)
        return counts[s]

    def enclosure(j: int) -> tuple[float, float]:
        """The closest shifts so far with eigenvalue ``j`` between them."""
        return max(s for s, c in counts.items() if c >= j), min(s for s, c in counts.items() if c < j)

    values, vectors = np.zeros(k), np.zeros((n, k))
    start = np.random.Generator(np.random.PCG64(11)).standard_normal((n, k))

    def apart(x: np.ndarray, j: int) -> np.ndarray:
        for _ in range(2):
            x = x - vectors[:, :j] @ (vectors[:, :j].T @ x)
        return x / np.linalg.norm(x)

    def solved(s: float, x: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - s * one, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (s + least) * one, x)
        return y if np.isfinite(y).all() else x

    for j in range(k):
        low, high = enclosure(j + 1)
        while True:
            while counts[low] - counts[high] > 1 and high - low > least:
                above((low + high) / 2)
                low, high = enclosure(j + 1)
            x = apart(start[:, j], j)
            for _ in range(3):
                x = apart(solved((low + high) / 2, x), j)
            value, gap, best = float(x @ v @ x), np.inf, x
            for _ in range(20):
                now = float(np.linalg.norm(v @ x - value * x))
                if now >= gap:
                    break
                gap, best, quotient = now, x, value
                x = apart(solved(value, x), j)
                value = float(x @ v @ x)
            value = quotient
            if high - low <= 4 * least or (gap <= 64 * least and above(value - 8 * least) > j >= above(value + 8 * least)):
                break
            above((low + high) / 2)
            low, high = enclosure(j + 1)
        values[j], vectors[:, j] = max(value, 0.0), best
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def whiten(rows: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation`` (decimal), ``whitened``, ``explained`` and ``identity_error`` of every vector and component.

    Vectors that are null, empty or hold null or non-finite entries have no rows. The fit is over all others of the most
    frequent length (the greater one of equals); vectors of another length have no rows either. A row is a vector, so repeated
    rows count as often as they occur and a null key is a key; other columns are not looked at. An entry beyond 2^60 counts
    as 2^60. There are as many components as a vector has entries, if those are fewer. A component without variance (equal
    vectors, fewer vectors than entries) has null ``whitened``, and ``identity_error`` leaves it out. Without vectors the
    result is empty. A deviation of more than 38 digits is null.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def totals(part):
        for own, x in integers(part.column("v")):
            d = x.shape[1]
            sums = [Decimal(int(s)) for s in (x >> 20).sum(0)], [Decimal(int(s)) for s in (x & 0xFFFFF).sum(0)]
            total = [a * 1048576 + b for a, b in zip(*sums, strict=True)]
            yield [np.full(d, d), np.arange(d), np.full(d, len(own)), pa.array(total, pa.decimal128(38, 0))]

    sums = map_batches(rows.select("v"), totals, "d int, i int, n long, s decimal(38,0)").groupBy("d", "i")
    sums = materialise(sums.agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")), "sums")
    best = sums.where("i = 0").orderBy(F.desc("n"), F.desc("d")).select("d", "n").first()
    result = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if best is None:
        return spark.createDataFrame([], result)
    d, n = best
    total = [int(r["s"]) for r in sums.where(F.col("d") == d).orderBy("i").collect()]
    middle = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, middle, strict=True)]
    centre = np.array(middle, np.int64)
    pairs = np.triu_indices(d)

    def products(part):
        """Sums of products of deviations from the whole number next to the mean: exact below 2^53."""
        found = np.zeros((d, d))
        for _, x in integers(part.column("v"), d):
            for at in range(0, len(x), ROWS):
                y = (x[at : at + ROWS] - centre).astype(float)
                found += y.T @ y
        yield [pairs[0], pairs[1], found[pairs]]

    summed = map_batches(rows.select("v"), products, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p"))
    v = np.zeros((d, d))
    for i, j, p in summed.collect():
        exact = (n * int(p) - rest[i] * rest[j]) / (n * n) if np.isfinite(p) else 0.0
        v[i, j] = v[j, i] = exact
    k = min(components, d)
    values, axes = leading(v, k)
    trace = float(np.trace(v))
    varied = values > d * _EPS * max(trace, _EPS)
    project = np.where(varied, axes / np.sqrt(np.where(varied, values, 1.0)), 0.0)
    offset = np.array([r / n for r in rest])

    def projected(part):
        for own, x in integers(part.column("v"), d):
            y = x - centre
            w = (y - offset) @ project
            w = pa.array([[float(a) if ok else None for a, ok in zip(row, varied, strict=True)] for row in w], pa.list_(pa.float64())) if not varied.all() else (
                pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * k), pa.array(w.ravel()))
            )
            yield [part.column("key").take(pa.array(own)), deviations(y, n, rest), w]

    found = map_batches(rows, projected, f"key {kind}, deviation decimal(38,0), w array<double>")
    found = materialise(found, "whitened")
    used = [c for c in range(k) if varied[c]]
    moments = [F.avg(F.col("w")[a]).alias(f"m{a}") for a in used]
    moments += [F.avg(F.col("w")[a] * F.col("w")[b]).alias(f"p{a}_{b}") for a in used for b in used if a <= b]
    error = None
    if used:
        at = found.agg(*moments).first().asDict()
        error = max(abs(at[f"p{a}_{b}"] - at[f"m{a}"] * at[f"m{b}"] - (a == b)) for a in used for b in used if a <= b)
    share = F.array(*[F.lit(float(e) / trace if trace > 0 else None).cast("double") for e in values])
    return found.select("key", "deviation", F.posexplode("w").alias("c", "whitened")).select(
        F.col("key").alias(key), (F.col("c") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("c")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def deviations(y: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """Sum over the entries of ``(n * y - rest)^2``, exact: 64 bits where a row cannot exceed them, whole numbers without bound else."""
    most = np.abs(y).max(1).astype(float) * n + max(map(abs, rest), default=0)
    small = most * most * y.shape[1] < 2.0**62
    out = np.full(len(y), None, object)
    if small.all():
        z = y * n - np.array(rest, np.int64)
        return pa.array((z * z).sum(1)).cast(pa.decimal128(38, 0))
    for i in range(len(y)):
        total = sum((n * int(a) - r) ** 2 for a, r in zip(y[i], rest, strict=True))
        out[i] = Decimal(total) if total < 10**38 else None
    return pa.array(list(out), pa.decimal128(38, 0))
