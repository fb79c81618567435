"""Functions over the content of a window: folds, and functions that see every element."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewright.operators.folding import process_groups
from tidewright.operators.ordered import Ordered, rows


def average(column: Column) -> Column:
    """Sum and count, combined before the shuffle, divided at the end."""
    return F.sum(column).cast("double") / F.count(column)


def window_elements(df: DataFrame, time: str, size: str, order, element: Column, keys=(), *, chunk_rows: int, **cut) -> DataFrame:
    """All elements of each keyed time window with its count, start and end.

    The list comes in chunks of ``chunk_rows`` elements in order, numbered from 0, because a window
    can hold more than a task can. A function that only needs to see the elements pass by is better served by
    :func:`process_time_windows`.
    """
    keys = list(keys)
    names = [order] if isinstance(order, str) else list(order)
    placed = df.withColumn("window_start", F.window(time, size)["start"]).withColumn("window_end", F.window(time, size)["end"])
    by = [*keys, "window_start", "window_end"]
    numbered = Ordered(placed, order, [*keys, "window_start"], **cut).running(__rn=rows()).whole(n=rows()).rows()
    chunk = F.floor((F.col("__rn") - 1) / chunk_rows).cast("long").alias("chunk")
    listed = F.sort_array(F.collect_list(F.struct(*names, element.alias("__e"))))
    return numbered.groupBy(*by, chunk, "n").agg(F.transform(listed, lambda e: e["__e"]).alias("elements"))


def process_time_windows(df: DataFrame, time: str, size: str, order, keys, function: Callable, schema: str) -> DataFrame:
    """A process function over whole keyed time windows: ``function(key, window, batches)`` yields rows of ``schema``.

    ``key`` are the values of ``keys``, ``window`` the start and the end, ``batches`` the elements in ``order`` as Arrow
    batches, read as they are asked for; a window may hold more than a task can. The result has keys, ``window_start``,
    ``window_end`` and the columns of ``schema``. Rows with a null time are in no window.
    """
    keys = list(keys)
    window = F.window(time, size)
    placed = df.withColumns({"window_start": window["start"], "window_end": window["end"]}).where(F.col("window_start").isNotNull())
    lead = [*keys, "window_start", "window_end"]

    def process(key: tuple, batches):
        for row in function(key[:-2], key[-2:], batches):
            yield (*key, *row)

    return process_groups(placed, lead, order, process, f"{_ddl(placed, lead)}, {schema}")


def process_count_windows(df: DataFrame, size: int, order, keys, function: Callable, schema: str, **cut) -> DataFrame:
    """The same over windows of ``size`` rows of a key; ``window`` is their number, ``win``. One that is not full never fires."""
    keys = list(keys)
    numbered = Ordered(df, order, keys, **cut).running(__rn=rows()).whole(__n=rows()).rows()
    win = F.floor((F.col("__rn") - 1) / size).cast("long")
    full = numbered.withColumn("win", win).where((F.col("win") + 1) * size <= F.col("__n")).drop("__n")
    lead = [*keys, "win"]

    def process(key: tuple, batches):
        for row in function(key[:-1], key[-1], batches):
            yield (*key, *row)

    return process_groups(full, lead, "__rn", process, f"{_ddl(full, lead)}, {schema}")


def _ddl(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def aggregate_function(
    df: DataFrame,
    keys: list[str],
    value: str,
    create: Callable[[], tuple],
    add: Callable[[tuple, pd.Series], tuple],
    merge: Callable[[tuple, tuple], tuple],
    accumulator: str,
    flush_keys: int = 50_000,
) -> DataFrame:
    """A user aggregate in Python: create, add, merge. Returns keys and the accumulator fields.

    Each task first folds its own rows (``add`` takes the values of a key within a batch), so the
    shuffle and the final merge see one small row per task and key, however hot the key. A task
    hands on its accumulators when it holds ``flush_keys`` of them.
    """
    fields = [f.strip().split()[0] for f in accumulator.split(",")]

    def rows_of(held: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, *a) for k, a in held.items()], columns=[*keys, *fields], dtype=object)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for key, part in pdf.groupby(keys, sort=False, dropna=False)[value]:
                key = key if isinstance(key, tuple) else (key,)
                held[key] = add(held.get(key) or create(), part)
            if len(held) >= flush_keys:
                yield rows_of(held)
                held = {}
        if held:
            yield rows_of(held)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches come sorted by key, so only the key at the end of a batch can go on."""
        key = acc = None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False, name=None):
                k = tuple(None if x != x else x for x in row[: len(keys)])
                a = row[len(keys) :]
                if key is not None and k == key:
                    acc = merge(acc, a)
                    continue
                if key is not None:
                    out.append((*key, *acc))
                key, acc = k, a
            if out:
                yield pd.DataFrame(out, columns=[*keys, *fields], dtype=object)
        if key is not None:
            yield pd.DataFrame([(*key, *acc)], columns=[*keys, *fields], dtype=object)

    return _fold_and_combine(df, keys, value, accumulator, fold, combine)


def _fold_and_combine(df: DataFrame, keys: list[str], value: str, accumulator: str, fold: Callable, combine: Callable) -> DataFrame:
    """``fold`` the rows of each task, deal what it yields by key, then ``combine`` it in the order of the keys."""
    kinds = {k: df.schema[k].dataType for k in keys}
    # pandas has whole numbers with nulls as floating point, so these keys go through it as text
    whole = [k for k in keys if isinstance(kinds[k], T.IntegralType)]
    key_ddl = ", ".join(f"`{k}` {'string' if k in whole else kinds[k].simpleString()}" for k in keys)
    schema = f"{key_ddl}, {accumulator}"
    passed = df.withColumns({k: F.col(k).cast("string") for k in whole})
    partial = passed.select(*keys, value).mapInPandas(fold, schema)
    done = partial.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(combine, schema)
    return done.withColumns({k: F.col(k).cast(kinds[k]) for k in whole})


def reduce_function(df: DataFrame, keys: list[str], value: str, function: Callable, kind: str) -> DataFrame:
    """Fold the values of a key with any associative and commutative Python function of two values."""
    from functools import reduce

    def add(acc: tuple, values: pd.Series) -> tuple:
        folded = reduce(function, values.tolist())
        return (folded,) if not acc else (function(acc[0], folded),)

    return aggregate_function(
        df, keys, value, tuple, add, lambda a, b: (function(a[0], b[0]),), f"{value} {kind}"
    )


def reduce_series(
    df: DataFrame, keys: list[str], value: str, function: Callable, kind: str, flush_keys: int = 50_000
) -> DataFrame:
    """Fold the values of a key with an associative and commutative function of Series.

    ``function`` takes two Series of the same length and combines them element by element. The values of all keys in a batch
    are folded by halves at once, so it is called once for each doubling of the longest key and not for each key or value.
    A task hands on its results when it holds ``flush_keys`` of them.
    """

    def rows_of(folded: dict) -> pd.DataFrame:
        return pd.DataFrame([(*k, v) for k, v in folded.items()], columns=[*keys, value], dtype=object)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            new = _by_halves(pdf, keys, value, function)
            held |= new | _pairwise(function, held, new)
            if len(held) >= flush_keys:
                yield rows_of(held)
                held = {}
        if held:
            yield rows_of(held)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches come sorted by key, so only the key at the end of a batch can go on."""
        last: dict = {}
        for pdf in batches:
            new = _by_halves(pdf, keys, value, function)
            done = last | new | _pairwise(function, last, new)
            last = dict([done.popitem()]) if done else {}
            if done:
                yield rows_of(done)
        if last:
            yield rows_of(last)

    return _fold_and_combine(df, keys, value, f"{value} {kind}", fold, combine)


def _by_halves(pdf: pd.DataFrame, keys: list[str], value: str, function: Callable) -> dict[tuple, object]:
    """The fold of each key, in the order in which the keys first come: the first half of its values with the second, again and again."""
    number = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
    order = np.argsort(number, kind="stable")
    left, number = pdf[value].take(order).reset_index(drop=True), number[order]
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]][: len(number)])
    heads = pdf[keys].take(order[starts])
    heads = zip(*[[None if x != x else x for x in heads[k].tolist()] for k in keys], strict=True)
    folded: list = [None] * len(starts)
    while len(left):
        size = np.bincount(number)[number]
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        place = np.arange(len(left)) - np.repeat(starts, size[starts])
        for i, v in zip(number[size == 1].tolist(), left[size == 1].tolist(), strict=True):
            folded[i] = v
        half = size // 2
        first = np.flatnonzero(place < half)
        if not len(first):
            break
        odd = np.flatnonzero((place == 2 * half) & (size > 1))
        both = function(left.take(first).reset_index(drop=True), left.take(first + half[first]).reset_index(drop=True))
        left = pd.concat([pd.Series(both), left.take(odd)], ignore_index=True) if len(odd) else pd.Series(both)
        number = np.r_[number[first], number[odd]]
        order = np.argsort(number, kind="stable")
        left, number = left.take(order).reset_index(drop=True), number[order]
    return dict(zip(heads, folded, strict=True))


def _pairwise(function: Callable, left: dict, right: dict) -> dict:
    """What both have, combined; values of one type at a time, as a Series of several would change some of them."""
    kinds: dict = {}
    for k in left.keys() & right.keys():
        kinds.setdefault((type(left[k]), type(right[k])), []).append(k)
    out: dict = {}
    for same in kinds.values():
        both = function(pd.Series([left[k] for k in same]), pd.Series([right[k] for k in same]))
        out |= zip(same, pd.Series(both).tolist(), strict=True)
    return out
