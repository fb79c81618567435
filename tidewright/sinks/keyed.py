"""Upserts: the last row written per key wins.

A batch is first reduced to its last row per key, in parallel, and only then written, so a writer
sees each key once per batch and a repeated batch has the same effect as the first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, functions as F

from tidewright.streaming.buckets import BucketedTable
from tidewright.streaming.tables import VersionedTable


def last_per_key(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The last row of each key; one row per task and key goes over the network."""
    names = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in names]
    last = df.groupBy(*keys).agg(F.max(F.struct(*names, *rest)).alias("last"))
    return last.select(*[F.col(c) if c in keys else F.col("last")[c].alias(c) for c in df.columns])


def upsert_into(table: VersionedTable | BucketedTable, keys: list[str], order) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that keeps a table with one row per key; a bucketed table is sent the batch's rows alone."""

    def write(batch: DataFrame, batch_id: int) -> None:
        new = last_per_key(batch, keys, order)
        if isinstance(table, BucketedTable):
            table.put(batch_id, new)
            return
        old = table.before(batch_id, new.schema)
        table.write(batch_id, last_per_key(old.unionByName(new), keys, order))

    return write


def write_each(write_rows: Callable[[Iterator[Row]], None], keys: list[str], order) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body for a key-value store: ``write_rows`` gets the rows of one partition.

    It runs in the tasks; opens its connection, writes in bulk and closes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last_per_key(batch, keys, order).foreachPartition(write_rows)

    return write


def merge_statement(target: str, staging: str, keys: list[str], values: list[str]) -> str:
    """The standard MERGE that upserts the staged rows."""
    match = " and ".join(f"t.{k} = s.{k}" for k in keys)
    update = ", ".join(f"{v} = s.{v}" for v in values)
    columns = [*keys, *values]
    return (
        f"merge into {target} t using {staging} s on {match} "
        f"when matched then update set {update} "
        f"when not matched then insert ({', '.join(columns)}) values ({', '.join('s.' + c for c in columns)})"
    )


def jdbc_upsert(options: dict[str, str], target: str, staging: str, keys: list[str], order,
                execute: Callable[[str], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: stage the batch's last rows over JDBC, then merge them in one statement."""

    def write(batch: DataFrame, batch_id: int) -> None:
        names = [order] if isinstance(order, str) else list(order)
        staged = last_per_key(batch, keys, order).drop(*[c for c in names if c not in keys])
        staged.write.format("jdbc").options(**options, dbtable=staging, truncate="true").mode("overwrite").save()
        execute(merge_statement(target, staging, keys, [c for c in staged.columns if c not in keys]))

    return write
