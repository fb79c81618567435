"""Pseudo-random columns computed from a row number, so a repeated task makes the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The constants of the generator.
MULTIPLIER = 1103515245
INCREMENT = 12345
MODULUS = 1 << 31

# The words a pair generator draws from.
WORDS = ("hadoop", "spark", "flink")


def seeded_int(n: Column, seed: int, bound: int) -> Column:
    """0..bound-1 from one step of a linear congruential generator; its upper bits are used."""
    step = (F.pmod(n.cast("long"), F.lit(MODULUS)) * MULTIPLIER + (seed + 1) * INCREMENT) % MODULUS
    return F.pmod(F.floor(step / 65536).cast("long"), F.lit(bound)).cast("int")


def seeded_uuid(n: Column, seed: int) -> Column:
    """A UUID-shaped id from the hash of seed and number."""
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), n.cast("string")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def order_rows(numbers: DataFrame, n: str, seed: int = 0, start_ms: int = 0) -> DataFrame:
    """Made-up orders, one per second: id, user_id 0-2, money 0-999, ts."""
    number = F.col(n)
    return numbers.select(
        seeded_uuid(number, seed).alias("id"),
        seeded_int(number, seed, 3).cast("string").alias("user_id"),
        seeded_int(number, seed + 1, 1000).alias("money"),
        (F.lit(start_ms).cast("long") + number.cast("long") * 1000).alias("ts"),
    )


def pair_rows(numbers: DataFrame, n: str, seed: int = 0) -> DataFrame:
    """Made-up pairs: a word and 0-99."""
    word = F.element_at(F.array(*[F.lit(w) for w in WORDS]), seeded_int(F.col(n), seed, len(WORDS)) + 1)
    return numbers.select(word.alias("k"), seeded_int(F.col(n), seed + 1, 100).alias("v"))
