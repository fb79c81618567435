"""Lookups in a dimension: a left join with a default for missing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.operators.ordered import Ordered, lowest, order_number

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def broadcast_if_small(df: DataFrame, most_rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most_rows`` rows and ``most_bytes`` as text, else as it is.

    Without the hint the join shuffles both sides and AQE splits the partitions of hot keys. No more
    than ``most_rows + 1`` rows are measured.
    """
    width = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    rows, size = df.limit(most_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= most_rows and size <= most_bytes else df


def last_put_wins(dimension: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the one put last."""
    others = [c for c in dimension.columns if c != key]
    last = dimension.groupBy(key).agg(F.max(F.struct(order, *[c for c in others if c != order])).alias("last"))
    return last.select(key, *[F.col("last")[c].alias(c) for c in others])


def lookup(facts: DataFrame, dimension: DataFrame, key: str, field: str, default: str) -> DataFrame:
    """``facts`` with ``field`` of the dimension row of the same key, or ``default``.

    A dimension too large to broadcast as a whole is still broadcast for the keys that many facts have.
    """
    from tidewright.operators.heavy import join_frequent

    rows = dimension.select(key, field)
    side = broadcast_if_small(rows)
    joined = facts.join(side, key, "left") if side is not rows else join_frequent(facts, rows, key, "left")
    return joined.withColumn(field, F.coalesce(F.col(field), F.lit(default)))


def file_dimension(spark, path: str, schema: str, sep: str) -> DataFrame:
    """A dimension kept in a delimited text file."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def rule_versions(rules: DataFrame, since: str) -> DataFrame:
    """The time span each rule set is in force: a new set replaces the whole of the one before.

    Works on the distinct times of the sets, one row per version.
    """
    times = rules.select(since).distinct()
    times = times.withColumn("__back", -order_number(times, since))
    following = Ordered(times, "__back").running({"until": lowest(since)}).rows().drop("__back")
    return rules.join(following, since).withColumnRenamed(since, "since")


def enrich_as_of(events: DataFrame, versions: DataFrame, key: str, time: str, bucket_seconds: int) -> DataFrame:
    """Inner join of each event with the rule of its key in force at its time.

    The span of a rule is cut into time buckets, so the join is an equi-join on key and bucket, and
    an event is compared with the versions of its bucket only. The last version ends at the last event.
    """
    first = _bucket(F.col("since"), bucket_seconds)
    last_event = events.agg(F.max(time)).scalar()
    last = _bucket(F.coalesce(F.col("until"), last_event), bucket_seconds)
    spread = versions.where(first <= last).withColumn("__bucket", F.explode(F.sequence(first, last)))
    side = broadcast_if_small(spread.withColumnRenamed(key, "__key"))
    at = events.withColumn("__at", _bucket(F.col(time), bucket_seconds))
    in_force = (F.col(time) >= F.col("since")) & (F.col("until").isNull() | (F.col(time) < F.col("until")))
    return at.join(
        side, (at[key] == side["__key"]) & (at["__at"] == side["__bucket"]) & in_force
    ).drop("__key", "__at", "__bucket", "since", "until")


def _bucket(column: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(column.cast("timestamp")) / seconds).cast("long")
