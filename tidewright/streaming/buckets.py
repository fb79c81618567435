"""Keyed tables that take changes as small files: bucketed by key, merged when they are read.

A write puts the changed rows of its batch into a delta, a folder with a file for each hash bucket; what is not changed is not
touched. A read takes the newest row of each key from the last base and the deltas after it. When the deltas have grown to the
size of the base they are merged into a new base, so all merging together writes a small multiple of what was
put in. A batch run again writes its delta again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewright.streaming.tables import Folder


class BucketedTable:
    """One row per key of ``keys``; the row with the highest ``order`` wins, of equal ones that of the latest write."""

    def __init__(self, spark: SparkSession, path: str, keys, order=(), buckets: int = 16):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.order = [order] if isinstance(order, str) else list(order)
        self.buckets = buckets
        self.deltas, self.bases = Folder(spark, f"{self.path}/deltas"), Folder(spark, f"{self.path}/bases")

    @staticmethod
    def _done(folder: Folder) -> list[int]:
        numbers = [int(n.removeprefix("seq=")) for n in folder.names() if n.startswith("seq=")]
        return sorted(n for n in numbers if folder.exists(f"seq={n}/_SUCCESS"))

    def sequence(self) -> int | None:
        """The number of the last write."""
        done = self._done(self.deltas) + self._done(self.bases)
        return max(done) if done else None

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.struct(*self.order, "__seq")).alias("last"))
        return last.select(*self.keys, *[F.col("last")[c].alias(c) for c in rest])

    def _save(self, folder: Folder, seq: int, rows: DataFrame) -> None:
        dealt = rows.withColumn("__bucket", self._bucket()).repartition(self.buckets, "__bucket")
        dealt.write.mode("overwrite").partitionBy("__bucket").parquet(f"{folder.path}/seq={seq}")

    def _rows(self, folder: Folder, numbers: list[int], schema: T.StructType) -> DataFrame:
        fields = T.StructType([*schema.fields, T.StructField("seq", T.LongType()), T.StructField("__bucket", T.IntegerType())])
        paths = [f"{folder.path}/seq={n}" for n in numbers]
        return self.spark.read.schema(fields).option("basePath", folder.path).parquet(*paths).withColumnRenamed("seq", "__seq")

    def before(self, seq: int, schema) -> DataFrame:
        """The rows as of the writes with lower numbers than ``seq``; ``schema`` names the columns."""
        return self._merged(seq, schema).select(*_struct(schema).names)

    def latest(self, schema) -> DataFrame:
        return self.before(1 << 62, schema)

    def _merged(self, seq: int, schema, bucket: int | None = None) -> DataFrame:
        schema = _struct(schema)
        bases = [n for n in self._done(self.bases) if n < seq]
        since = bases[-1] if bases else None
        deltas = [n for n in self._done(self.deltas) if n < seq and (since is None or n > since)]
        parts = [self._rows(self.bases, [since], schema)] if bases else []
        parts += [self._rows(self.deltas, deltas, schema)] if deltas else []
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = reduce(DataFrame.unionByName, parts)
        if bucket is not None:
            rows = rows.where(F.col("__bucket") == bucket)
        return self._newest(rows.drop("__bucket")).drop("__seq")

    def lookup(self, schema, **key) -> DataFrame:
        """The row of one key, from the files of its bucket."""
        kinds = _struct(schema)
        values = self.spark.range(1).select(*[F.lit(key[k]).cast(kinds[k].dataType).alias(k) for k in self.keys])
        bucket = values.select(self._bucket()).first()[0]
        rows = self._merged(1 << 62, schema, bucket)
        for k in self.keys:
            rows = rows.where(F.col(k).eqNullSafe(F.lit(key[k])))
        return rows.select(*kinds.names)

    def put(self, seq: int, changed: DataFrame) -> None:
        """Write the rows of batch ``seq``, reduced to the newest of each key, and merge if the deltas ask for it."""
        names = changed.columns
        one = self._newest(changed.withColumn("__seq", F.lit(seq).cast("long"))).select(*names)
        self._save(self.deltas, seq, one)
        bases = self._done(self.bases)
        fresh = [n for n in self._done(self.deltas) if n > bases[-1]] if bases else self._done(self.deltas)
        size = sum(self.deltas.size(f"seq={n}") for n in fresh)
        if len(fresh) > 1 and size >= (self.bases.size(f"seq={bases[-1]}") if bases else size):
            self.compact(changed.schema)

    def compact(self, schema) -> None:
        """Merge all deltas into a base. The base before stays with its deltas, for a batch that is run again."""
        last = self.sequence()
        bases = self._done(self.bases)
        if last is None or bases and bases[-1] == last:
            return
        self._save(self.bases, last, self._merged(1 << 62, schema))
        keep = bases[-1] if bases else None
        if keep is not None:
            for n in self._done(self.deltas):
                if n <= keep:
                    self.deltas.delete(f"seq={n}")
            for n in bases[:-1]:
                self.bases.delete(f"seq={n}")

    def start_from(self, savepoint, schema) -> None:
        """Take over the rows of another job's table, to be found by the first batch of this one."""
        self.put(-1, savepoint.latest(schema))


def _struct(schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
