"""Running folds and window functions with a user's code, over sorted rows in Arrow batches.

``running_fold`` is a parallel prefix scan. Rows are dealt into ranges of key and order, so a key of any size spans as many
tasks as its rows ask for. Each task folds its range, a scan over one row of each range gives what comes before it, and a
second pass puts that in front of the rows that go on with the key of the range before.

``process_groups`` hands each group to a function as a stream of batches in order; no group is ever held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewright.session import materialise

#: Combines what comes first with what comes next, row by row of two frames with the fields of the fold.
Fold = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]


def changes(columns: list[pa.Array]) -> np.ndarray:
    """Whether each row but the first differs from the one before it; null equals null and NaN equals NaN."""
    n = len(columns[0]) - 1 if columns else 0
    new = np.zeros(max(n, 0), bool)
    for column in columns:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if pa.types.is_nested(column.type):
            values = column.to_pylist()
            new |= np.array([a != b for a, b in zip(values[1:], values[:-1], strict=True)], bool)
            continue
        here, before = column.slice(1), column.slice(0, n)
        differ = pc.fill_null(pc.not_equal(here, before), False)
        if pa.types.is_floating(column.type):
            both = pc.and_(pc.fill_null(pc.is_nan(here), False), pc.fill_null(pc.is_nan(before), False))
            differ = pc.and_not(differ, both)
        differ = pc.or_(differ, pc.not_equal(here.is_null(), before.is_null()))
        new |= differ.to_numpy(zero_copy_only=False)
    return new


def scan(values: pd.DataFrame, starts: np.ndarray, function: Fold) -> pd.DataFrame:
    """Inclusive prefix fold of each segment; ``starts`` marks first rows. Every step doubles how far a row reaches back."""
    n = len(values)
    place = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0)) if n else np.zeros(0, int)
    values, step = values.reset_index(drop=True), 1
    while n and step <= place.max():
        at = np.flatnonzero(place >= step)
        values = _put(values, at, function(values.take(at - step).reset_index(drop=True), values.take(at).reset_index(drop=True)))
        step *= 2
    return values


def _put(values: pd.DataFrame, at: np.ndarray, new: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for name in values.columns:
        column = values[name].to_numpy(copy=True)
        column[at] = new[name].to_numpy()
        out[name] = column
    return pd.DataFrame(out)


def _frame(columns: list[pa.Array], names: list[str]) -> tuple[pd.DataFrame, np.ndarray]:
    """The fields of rows without a null in any of them, and where those rows are."""
    there = np.ones(len(columns[0]), bool)
    for column in columns:
        there &= ~column.is_null().to_numpy(zero_copy_only=False)
    at = pa.array(np.flatnonzero(there))
    return pd.DataFrame({n: c.take(at).to_numpy(zero_copy_only=False) for n, c in zip(names, columns, strict=True)}), there


def running_fold(
    df: DataFrame, keys, fields: dict[str, str], order, function: Fold, parts: int | None = None
) -> DataFrame:
    """``df`` with the fold of all rows of the key up to each row, in ``order``.

    ``fields`` names the columns that are folded and the columns that take the results; the types stay. ``function`` must be
    associative and need not be commutative. It gets two frames of the same length with the folded columns and returns one,
    each row combined on its own, so it is called a few times a batch and never for a single row. A row with a null in a
    folded column adds nothing and shows the result so far, null at the beginning. Order columns may be of any type that
    sorts; with ``keys`` they should be unique, or rows of a tie come in any order.

    ``parts`` is the number of ranges (by default of shuffle partitions) and does not change the result, nor does a key that
    holds most of the rows. One row of each range goes through the driver.
    """
    spark = df.sparkSession
    keys, order = ([x] if isinstance(x, str) else list(x) for x in (keys, order))
    names, results = list(fields), list(fields.values())
    local = [f"__fold_{r}" for r in results]
    marks = ["__part", "__first", "__last"]
    kinds = T.StructType([
        *df.schema.fields, *[T.StructField(x, df.schema[n].dataType) for n, x in zip(names, local, strict=True)],
        T.StructField("__part", T.IntegerType()), T.StructField("__first", T.BooleanType()), T.StructField("__last", T.BooleanType()),
    ])
    arrow = to_arrow_schema(kinds)
    types = [arrow.field(x).type for x in local]

    def fold_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tail, carried, first, held = TaskContext.get().partitionId(), None, None, True, None
        for rows in batches:
            n = rows.num_rows
            if not n:
                continue
            if held is not None:
                yield held
            own = [rows.column(k) for k in keys]
            new = np.zeros(n, bool)
            if keys:
                new[1:] = changes(own)
                if tail is not None:
                    new[0] = changes([pa.concat_arrays([t, c.slice(0, 1)]) for t, c in zip(tail, own, strict=True)])[0]
            tail = [c.slice(n - 1) for c in own]
            segment = np.cumsum(new)
            values, there = _frame([rows.column(x) for x in names], names)
            starts = np.ones(len(values), bool)
            inner = segment[there]
            starts[1:] = inner[1:] != inner[:-1]
            values = scan(values, starts, function)
            goes_on = np.flatnonzero(inner == 0)
            if carried is not None and len(goes_on):
                before = carried.take(np.zeros(len(goes_on), int)).reset_index(drop=True)
                values = _put(values, goes_on, function(before, values.take(goes_on).reset_index(drop=True)))
            seen = np.cumsum(there) - 1
            begin = np.r_[0, np.cumsum(np.bincount(inner, minlength=segment[-1] + 1))][segment]
            known = seen >= begin
            if carried is not None:
                values = pd.concat([values, carried], ignore_index=True)
                seen = np.where(known, seen, len(values) - 1)
                known = known | (segment == 0)
            at = pa.array(seen, mask=~known)
            columns = [pa.array(values[x].to_numpy(), t).take(at) for x, t in zip(names, types, strict=True)]
            carried = values.take([seen[-1]]).reset_index(drop=True) if known[-1] else None
            flags = first & (segment == 0)
            first = first and segment[-1] == 0
            held = pa.RecordBatch.from_arrays([*rows.columns, *columns, pa.array(np.full(n, part, np.int32)), pa.array(flags), pa.array(np.zeros(n, bool))], schema=arrow)
        if held is not None:
            last = np.zeros(held.num_rows, bool)
            last[-1] = True
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.array(last)], schema=arrow)

    dealt = df.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, *order)
    done = materialise(dealt.sortWithinPartitions(*keys, *order).mapInArrow(fold_range, kinds), "folds")
    firsts = done.where("__first").groupBy("__part").agg(*[F.first(k).alias(k) for k in keys]) if keys else done.where("__first").select("__part").distinct()
    heads = firsts.select("__part", *[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)])
    ends = done.where("__last").join(heads, "__part").orderBy("__part")
    carry = _before_each_range(ends.toArrow(), keys, names, local, function)
    keep = [*df.columns, *results]

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = carry
        for rows in batches:
            part = rows.column("__part").to_numpy()
            at = place[part] if len(place) else np.full(len(part), -1)
            first = rows.column("__first").to_numpy(zero_copy_only=False) & (at >= 0)
            out = [rows.column(x) for x in local]
            if first.any():
                values, there = _frame(out, names)
                both = np.flatnonzero(first[there])
                before = known.take(at[there][both]).reset_index(drop=True)
                if len(both):
                    values = _put(values, both, function(before, values.take(both).reset_index(drop=True)))
                only = np.flatnonzero(first & ~there)
                where = np.where(there, np.cumsum(there) - 1, -1)
                where[only] = len(values) + np.arange(len(only))
                values = pd.concat([values, known.take(at[only])], ignore_index=True)
                index = pa.array(where, mask=where < 0)
                out = [pa.array(values[x].to_numpy(), t).take(index) for x, t in zip(names, types, strict=True)]
            columns = [rows.column(c) for c in df_columns]
            yield pa.RecordBatch.from_arrays([*columns, *out], schema=final_arrow)

    df_columns = df.columns
    final = T.StructType([*df.schema.fields, *[T.StructField(r, df.schema[n].dataType) for n, r in zip(names, results, strict=True)]])
    final_arrow = to_arrow_schema(final)
    return done.drop("__last").mapInArrow(go_on, final).select(*keep)


def _before_each_range(ends: pa.Table, keys: list[str], names: list[str], local: list[str], function: Fold) -> tuple[pd.DataFrame, np.ndarray]:
    """Of each range, what the ranges before it have of its first key: the folds, and the place of the range among them or -1.

    ``ends`` has the last row of each range, with the first key of the range. The folds of the last keys are scanned; a range
    begins a segment of the scan if it does not lie wholly within the key of the range before.
    """
    n = ends.num_rows
    if not n:
        return pd.DataFrame(columns=names), np.zeros(0, int)
    parts = ends.column("__part").to_numpy()
    same = np.ones(n, bool)  # the first key of a range is the last of the range before
    same[0] = False
    for i, key in enumerate(keys):
        last, head = ends.column(key).combine_chunks(), ends.column(f"__h{i}").combine_chunks()
        pairs = pa.concat_arrays([x for j in range(1, n) for x in (last.slice(j - 1, 1), head.slice(j, 1))]) if n > 1 else last.slice(0, 0)
        same[1:] &= ~changes([pairs])[::2] if n > 1 else True
    single = ends.column("__first").to_numpy()
    within = same & single
    values, there = _frame([ends.column(x).combine_chunks() for x in local], names)
    segment = np.cumsum(~within)
    inner = segment[there]
    starts = np.r_[True, inner[1:] != inner[:-1]][: len(inner)]
    values = scan(values, starts, function)
    seen = np.cumsum(there) - 1
    begin = np.r_[0, np.cumsum(np.bincount(inner, minlength=segment[-1] + 1))][segment]
    up_to = np.where(seen >= begin, seen, -1)
    place = np.full(int(parts.max()) + 1, -1)
    place[parts[1:]] = np.where(same[1:], up_to[:-1], -1)
    return values, place


def process_groups(df: DataFrame, keys, order, function: Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[tuple]], schema: str, batch_rows: int = 10_000) -> DataFrame:
    """``function(key, batches)`` for every group of ``keys``; it yields tuples, the rows of ``schema``.

    ``batches`` are the rows of the group, all columns of ``df``, in ``order``; each is a slice of an Arrow batch and costs
    nothing to make. They come as they are read: a function that holds on to nothing runs in bounded memory, however many
    rows a group has. One that stops early skips the rest. A group is one task's, since its rows are given in order; where
    the function is associative, ``running_fold`` or an aggregate spreads it. Groups are what is there: no rows, no call.
    """
    keys, order = ([x] if isinstance(x, str) else list(x) for x in (keys, order))
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        number, tail = 0, None
        for rows in batches:
            if not rows.num_rows:
                continue
            own = [rows.column(k) for k in keys]
            edges = np.flatnonzero(changes(own)) + 1
            if tail is not None and changes([pa.concat_arrays([t, c.slice(0, 1)]) for t, c in zip(tail, own, strict=True)])[0]:
                number += 1
            tail = [c.slice(rows.num_rows - 1) for c in own]
            for i, (a, b) in enumerate(zip([0, *edges], [*edges, rows.num_rows], strict=True)):
                number += i > 0
                yield number, rows.slice(a, b - a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, group in groupby(pieces(batches), key=lambda piece: piece[0]):
            first = next(group)[1]
            key = tuple(first.column(k)[0].as_py() for k in keys)
            for row in function(key, chain([first], (rows for _, rows in group))):
                out.append(row)
                if len(out) >= batch_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
