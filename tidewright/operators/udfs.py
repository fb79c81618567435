"""User functions in Python, in Arrow batches. Prefer a column expression where there is one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F


def map_values(df: DataFrame, column: str, function: Callable[[pd.Series], pd.Series], name: str, kind: str) -> DataFrame:
    """A new column from a function of whole Arrow batches."""
    return df.withColumn(name, F.pandas_udf(function, kind)(F.col(column)))


def map_with_setup(df: DataFrame, setup: Callable[[], object], function: Callable[[object, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Rows through a function that needs something set up once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = setup()
        for pdf in batches:
            yield function(held, pdf)

    return df.mapInPandas(run, schema)


def filter_values(df: DataFrame, column: str, keep: Callable[[pd.Series], pd.Series]) -> DataFrame:
    return df.where(F.pandas_udf(keep, "boolean")(F.col(column)))


def flat_map(df: DataFrame, column: str, function: Callable[[str], list], name: str, kind: str, chunk_rows: int = 10_000) -> DataFrame:
    """Zero or more rows for each row: the function's list. A task holds one list and ``chunk_rows`` rows before they go on."""

    def rows(found: list) -> pd.DataFrame:
        return pd.DataFrame({name: pd.Series(found, dtype=object)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list = []
            for value in pdf[column]:
                made = function(value)
                for at in range(0, 0 if made is None else len(made), chunk_rows):
                    found.extend(made[at : at + chunk_rows])
                    if len(found) >= chunk_rows:
                        yield rows(found)
                        found = []
            if found:
                yield rows(found)

    return df.select(column).mapInPandas(run, f"`{name}` {kind}")
