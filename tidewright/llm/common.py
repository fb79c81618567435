"""Words, shingles and hashes of whole texts as numpy arrays, and small helpers of the operators.

Texts come as Arrow string columns and are worked on as bytes, a bounded stretch of rows at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Bytes of text that are worked on at a time; a longer text is a stretch of its own.
STRETCH = 1 << 20
#: Bytes of an Arrow batch; Spark and Python each hold a few of them for each task.
BATCH_BYTES = 1 << 23

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_random = np.random.Generator(np.random.PCG64(20240229))
#: A random number for each byte, the same for both cases of A to Z, and 0 for blanks.
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_BLANK] = 0
_BASE = 0x9E3779B97F4A7C15
_FACTORS = _random.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers["up"]) < n:
        n = max(n, STRETCH + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the place where each row begins; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, ends, data = texts.buffers()
    places = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if ends is not None and len(texts) else np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def stretches(texts: pa.Array, most: int = STRETCH) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row (exclusive), bytes and row places, for stretches of at most ``most`` bytes or one row."""
    data, places = text_bytes(texts)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(places, places[row] + most, "right")) - 1)
        end = min(end, len(texts), row + 65536)
        yield row, end, data[places[row] : places[end]], places[row : end + 1] - places[row]
        row = end


def word_starts(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word ``[^\\x20\\x09-\\x0D]+`` begins in the bytes, and where the words of each row begin."""
    inside = ~_BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = places[:-1][places[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, places)


def word_hashes(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, and where the words of each row begin."""
    starts, rows = word_starts(data, places)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    up, down = _power_tables(len(data))
    sums = np.add.reduceat(_BYTE[data] * up[: len(data)], starts)
    return mixed(sums * down[starts]), rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a row, and where those of each row begin.

    A row with fewer words gives one hash, of all its words; a row without words none.
    """
    counts = np.diff(rows)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(begin[-1], np.uint64)
    long = np.flatnonzero(counts >= k)
    if len(long):
        whole = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            whole += words[j : len(words) - k + 1 + j] * _FACTORS[j]
        take = np.ones(begin[-1], bool)
        for r in np.flatnonzero((counts < k) & (counts > 0)):
            take[begin[r]] = False
        at = np.repeat(rows[:-1][long] - begin[:-1][long], n[long]) + np.flatnonzero(take)
        out[take] = mixed(whole[at])
    for r in np.flatnonzero((counts < k) & (counts > 0)):
        part = words[rows[r] : rows[r + 1]]
        out[begin[r]] = mixed(np.array([(part * _FACTORS[: len(part)]).sum() + np.uint64(len(part))], np.uint64))[0]
    return out, begin


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, begin: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from its flat values and where each row begins."""
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values, kind))


def batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    """A record batch of a Spark schema's names and types."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) and c.type != f.type else c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kinds])


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of this session end at ``BATCH_BYTES``, however long its texts are; a longer row is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` from a record batch to an iterator of column lists, over each batch of ``df``."""
    small_batches(df.sparkSession)
    kinds = T.StructType.fromDDL(schema)

    def run(batches):
        for part in batches:
            for columns in function(part):
                yield batch(kinds, columns)

    return df.mapInArrow(run, kinds)


def by_group(parts, keys: tuple[str, ...]):
    """Columns of the rows of each run of equal ``keys``, from batches sorted by them."""
    held, now = [], None
    for part in parts:
        values = [np.asarray(part.column(k)) for k in keys]
        new = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1 if part.num_rows else []
        edges = [0, *new, part.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            key = tuple(int(v[a]) for v in values)
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part.slice(a, b - a))
            now = key
    if held:
        yield pa.Table.from_batches(held)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5
