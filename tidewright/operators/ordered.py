"""Running aggregates along an order, per key or over all rows.

``Window.partitionBy(key).orderBy(seq)`` hands every row of a key to one task, so one key with a
third of the rows decides the run time, and with no key at all a single task gets the table. Here
such groups are cut into slices along the order first. A slice is a window partition of its own;
what the earlier slices add up to comes from a table with one row per slice. Keys that fit in one
task keep the plain window and the same single shuffle.

The cut is decided from a sample: a group that holds more than ``rows_per_slice`` is cut into equal
spans of the order value, meant to be half full, and a span that still holds too much is cut again.
A span of a single value is cut along the next order column. A span is less than half of the one it is cut from, so
this ends after as many levels as an order value has bits. Only the layout depends on the sample. Any cut along the order gives the same results, and no row is
left out. The limit never falls below ``total / MOST_GROUPS``, so fewer than ``MOST_GROUPS`` groups
can be over it at any level. That bounds the tables broadcast here whatever the size of the data.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewright.session import materialise

ROWS_FLOOR = 1 << 18
ROWS_CEILING = 1 << 22
MOST_GROUPS = 1 << 16
SAMPLED_PER_SLICE = 2000


class Running(NamedTuple):
    """An aggregate that can be continued from the result of the rows before."""

    kind: str
    column: Column


def total(column, scale: int | None = None) -> Running:
    """A sum. With ``scale``, values are rounded to so many decimal places and added exactly, so that the result, a decimal, does
    not depend on where the rows are cut; a sum of doubles does, in its last bits, as it does on any order of rows.
    """
    column = F.col(column) if isinstance(column, str) else column
    return Running("sum", column if scale is None else column.cast(f"decimal({min(38, 20 + scale)},{scale})"))


def rows(condition: Column | None = None) -> Running:
    one = F.lit(1).cast("long")
    return Running("rows", one if condition is None else F.when(condition, one).otherwise(F.lit(0).cast("long")))


def lowest(column) -> Running:
    return Running("min", F.col(column) if isinstance(column, str) else column)


def highest(column) -> Running:
    return Running("max", F.col(column) if isinstance(column, str) else column)


_AGGREGATE = {"sum": F.sum, "rows": F.sum, "min": F.min, "max": F.max}


def _continue(kind: str, before: Column, here: Column) -> Column:
    if kind == "min":
        return F.least(before, here)
    if kind == "max":
        return F.greatest(before, here)
    return F.coalesce(before + here, before, here)


def order_number(df: DataFrame, name: str) -> Column:
    """The order column as a long, so that spans of it can be computed."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("long")
    raise TypeError(f"{name}: order by an integer, date or timestamp column, not {kind.simpleString()}")


def countable(df: DataFrame, name: str) -> bool:
    """Whether :func:`order_number` knows the column's type."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.TimestampType, T.TimestampNTZType, T.DateType)
    return isinstance(df.schema[name].dataType, kinds)


def _apart(high: Column, low: Column) -> Column:
    """The difference of two longs, however far apart they are."""
    return (high.cast("decimal(19,0)") - low.cast("decimal(19,0)")).cast("double")


def _all(conditions: list[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


class Ordered:
    """``df`` in the order of ``order`` within ``keys``, cut into slices where a group is too large.

    The first order column must be an integer, date or timestamp; the others break its ties, and many rows of one
    value are cut along those of them that are such columns too. The
    whole list must be unique within a key for the running results to be deterministic, and ``df``
    must give the same rows when it is read again.
    """

    def __init__(self, df: DataFrame, order, keys=(), rows_per_slice: int | None = None, sizing: DataFrame | None = None):
        """``sizing`` holds at least the rows of ``df`` with its keys and order and is cheaper to count."""
        self.order = [order] if isinstance(order, str) else list(order)
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.levels: list[str] = []
        self.df = df
        self._cut(rows_per_slice, df if sizing is None else sizing)

    def _cut(self, rows_per_slice: int | None, sizing: DataFrame) -> None:
        rows_in_all = sizing.count()
        if rows_per_slice is None:
            tasks = int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            rows_per_slice = max(ROWS_FLOOR, min(rows_in_all // tasks, ROWS_CEILING))
        limit = max(rows_per_slice, rows_in_all // MOST_GROUPS)
        if rows_in_all <= limit:
            return
        share = min(1.0, SAMPLED_PER_SLICE / limit)
        places = [c for i, c in enumerate(self.order) if i == 0 or countable(self.df, c)]
        sample = sizing.select(*self.keys, *[order_number(sizing, c).alias(f"__place{i}") for i, c in enumerate(places)])
        sample = materialise(sample.sample(share, seed=1) if share < 1 else sample)
        for i, column in enumerate(places):
            sample = self._cut_along(sample, f"__place{i}", order_number(self.df, column), limit * share)

    def _cut_along(self, sample: DataFrame, name: str, place: Column, most: float) -> DataFrame:
        """Cut along one order column what has more than ``most`` sampled rows, level by level."""
        cut_before = sample
        while True:
            by = self.keys + self.levels
            groups = cut_before.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min(name).alias("__lo"), F.max(name).alias("__hi"))
            crowded = groups.where((F.col("__n") > most) & (F.col("__hi") > F.col("__lo")))
            span = _apart(F.col("__hi"), F.col("__lo")) + 1
            crowded = materialise(
                crowded.select(
                    *[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)],
                    F.col("__lo"),
                    F.greatest(F.lit(1.0), span * (most / 2) / F.col("__n")).alias("__width"),
                )
            )
            if crowded.isEmpty():
                return sample
            self.df = self._slice(self.df, place, by, crowded)
            sample = self._slice(sample, F.col(name), by, crowded)
            self.levels.append(f"__slice{len(self.levels)}")
            cut_before = sample.where(F.col(self.levels[-1]).isNotNull())

    def _slice(self, df: DataFrame, place: Column, by: list[str], crowded: DataFrame) -> DataFrame:
        """Number the slices of the crowded groups; fewer than MOST_GROUPS of them are broadcast."""
        if by:
            same = _all([df[c].eqNullSafe(crowded[f"__by{i}"]) for i, c in enumerate(by)])
            wide, lo, width = df.join(F.broadcast(crowded), same, "left"), F.col("__lo"), F.col("__width")
        else:
            only = crowded.first()
            wide, lo, width = df, F.lit(only["__lo"]), F.lit(only["__width"])
        first = F.lit(-(1 << 63))
        number = F.when(width.isNotNull(), F.coalesce(F.floor(_apart(place, lo) / width).cast("long"), first))
        return wide.withColumn(f"__slice{len(self.levels)}", number).drop(
            "__lo", "__width", *[f"__by{i}" for i in range(len(by))]
        )

    def with_columns(self, **columns: Column) -> "Ordered":
        """Add row-wise columns; the slices stay as they are."""
        return self._like(self.df.withColumns(columns))

    def running(self, before: dict[str, Running] | None = None, **up_to: Running) -> "Ordered":
        """Add aggregates over the rows up to this one, and those of ``before`` over the rows before it."""
        before = before or {}
        by = Window.partitionBy(*self.keys, *self.levels).orderBy(*self.order)
        ends = {name: Window.currentRow for name in up_to} | {name: -1 for name in before}
        wanted = {**up_to, **before}
        result = self.df.withColumns(
            {
                name: _AGGREGATE[a.kind](a.column).over(by.rowsBetween(Window.unboundedPreceding, ends[name]))
                for name, a in wanted.items()
            }
        )
        if self.levels:
            earlier = (
                Window.partitionBy(*self._aliases()[: len(self.keys)])
                .orderBy(*self._aliases()[len(self.keys) :])
                .rowsBetween(Window.unboundedPreceding, -1)
            )
            result = self._carry(result, wanted, earlier)
        return self._like(self._filled(result, wanted))

    def whole(self, **aggregates: Running) -> "Ordered":
        """Add each aggregate over all rows of the key to every row, without another shuffle."""
        inside = Window.partitionBy(*self.keys, *self.levels)
        here = {name: _AGGREGATE[a.kind](a.column).over(inside) for name, a in aggregates.items()}
        result = self.df.withColumns(here)
        if self.levels:
            others = Window.partitionBy(*self._aliases()[: len(self.keys)])
            result = self._carry(result, aggregates, others, replace=True)
        return self._like(self._filled(result, aggregates))

    def _aliases(self) -> list[str]:
        """Names of keys and levels in the table of slices."""
        return [f"__of_{c}" for c in self.keys + self.levels]

    def _carry(self, result, aggregates, window, replace=False) -> DataFrame:
        """Join what the other slices add up to; the table of slices has a row per slice of a cut group."""
        names, alias = self.keys + self.levels, self._aliases()
        slices = (
            self.df.where(F.coalesce(*[F.col(c) for c in self.levels]).isNotNull())
            .groupBy(*[F.col(c).alias(a) for c, a in zip(names, alias)])
            .agg(*[_AGGREGATE[a.kind](a.column).alias(name) for name, a in aggregates.items()])
        )
        carry = slices.select(
            *alias,
            *[
                _AGGREGATE[a.kind](F.col(name)).over(window).alias(f"__carry_{name}")
                for name, a in aggregates.items()
            ],
        )
        same = _all([result[c].eqNullSafe(carry[a]) for c, a in zip(names, alias)])
        joined = result.join(F.broadcast(carry), same, "left")
        return joined.withColumns(
            {
                name: (
                    F.coalesce(F.col(f"__carry_{name}"), F.col(name))
                    if replace
                    else _continue(a.kind, F.col(f"__carry_{name}"), F.col(name))
                ).cast(result.schema[name].dataType)
                for name, a in aggregates.items()
            }
        ).drop(*alias, *[f"__carry_{name}" for name in aggregates])

    @staticmethod
    def _filled(result, aggregates) -> DataFrame:
        zero = F.lit(0).cast("long")
        return result.withColumns(
            {name: F.coalesce(F.col(name), zero) for name, a in aggregates.items() if a.kind == "rows"}
        ) if any(a.kind == "rows" for a in aggregates.values()) else result

    def _like(self, df: DataFrame) -> "Ordered":
        other = object.__new__(Ordered)
        other.order, other.keys, other.levels, other.df = self.order, self.keys, self.levels, df
        return other

    def rows(self) -> DataFrame:
        """The rows with the added columns."""
        return self.df.drop(*self.levels)
