"""Keyed aggregates: the final row per key, or the updated row after every input row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.operators.ordered import Ordered, highest, lowest, order_number, total


def key_columns(df: DataFrame, *selectors) -> list[Column]:
    """Key selectors to columns: a field position, a field name or an expression."""
    chosen = []
    for selector in selectors:
        if isinstance(selector, int):
            chosen.append(F.col(df.columns[selector]))
        elif isinstance(selector, str):
            chosen.append(F.col(selector))
        else:
            chosen.append(selector)
    return chosen


def final_sum(df: DataFrame, keys, value, name: str = "sum") -> DataFrame:
    return df.groupBy(*key_columns(df, *keys)).agg(F.sum(value).alias(name))


def running_sum(df, keys, value, order, name="sum", **cut) -> DataFrame:
    return Ordered(df, order, keys, **cut).running(**{name: total(value)}).rows()


def _place(df: DataFrame, order) -> list[Column]:
    return [order_number(df, c) for c in ([order] if isinstance(order, str) else order)]


def _running_extreme(df, keys, value, order, others, other_fields, extreme, cut) -> DataFrame:
    """``value`` becomes the running extreme; the other fields come from the first or the last row."""
    if other_fields not in ("first", "last"):
        raise ValueError("other_fields is 'first' or 'last'")
    result = {f"__x_{value}": extreme(value)}
    if other_fields == "first" and others:
        result["__first"] = lowest(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(_place(df, order))], *others))
    out = Ordered(df, order, keys, **cut).running(**result).rows()
    fields = {value: F.col(f"__x_{value}")}
    if "__first" in result:
        fields |= {c: F.col("__first")[c] for c in others}
    return out.withColumns(fields).drop(f"__x_{value}", "__first")


def running_min(df, keys, value, order, others=(), other_fields="first", **cut) -> DataFrame:
    return _running_extreme(df, keys, value, order, list(others), other_fields, lowest, cut)


def running_max(df, keys, value, order, others=(), other_fields="first", **cut) -> DataFrame:
    return _running_extreme(df, keys, value, order, list(others), other_fields, highest, cut)


def _ranked(df, value, order, payload, sign) -> Column:
    """The row under its value and place; null, which every extreme skips, where the value is null."""
    place = [(p if sign > 0 else -p).alias(f"p{i}") for i, p in enumerate(_place(df, order))]
    ranked = F.struct(F.col(value).alias("v"), *place, F.struct(*payload).alias("row"))
    return F.when(F.col(value).isNotNull(), ranked)


def running_minby(df, keys, value, order, payload, prefix="min_", **cut) -> DataFrame:
    """After each row, the fields of the first row with the smallest value so far."""
    out = Ordered(df, order, keys, **cut).running(__best=lowest(_ranked(df, value, order, payload, 1))).rows()
    return out.withColumns({prefix + c: F.col("__best.row")[c] for c in payload}).drop("__best")


def running_maxby(df, keys, value, order, payload, prefix="max_", **cut) -> DataFrame:
    """After each row, the fields of the first row with the largest value so far."""
    out = Ordered(df, order, keys, **cut).running(__best=highest(_ranked(df, value, order, payload, -1))).rows()
    return out.withColumns({prefix + c: F.col("__best.row")[c] for c in payload}).drop("__best")


def final_minby(df, keys, value, order, payload) -> DataFrame:
    """One row per key: the first row with the smallest value. Partial aggregation keeps one row per task."""
    best = df.groupBy(*keys).agg(F.min(_ranked(df, value, order, payload, 1)).alias("best"))
    return best.select(*keys, *[F.col("best.row")[c].alias(c) for c in payload])


def final_maxby(df, keys, value, order, payload) -> DataFrame:
    best = df.groupBy(*keys).agg(F.max(_ranked(df, value, order, payload, -1)).alias("best"))
    return best.select(*keys, *[F.col("best.row")[c].alias(c) for c in payload])


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs; nothing is removed."""
    return reduce(DataFrame.unionByName, others, first)
