"""Tables a stream writes batch by batch, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewright.session import new_dir, use_rocksdb


class Folder:
    """File operations through the file system Spark itself uses for the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        at = self._path(self.path)
        if not self._fs.exists(at):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(at)]

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def size(self, name: str) -> int:
        """Bytes of all files below."""
        return self._fs.getContentSummary(self._path(f"{self.path}/{name}")).getLength()

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


class VersionedTable:
    """A table with one whole version per batch.

    A batch reads the version before it and writes its own, so running a batch again overwrites its
    own version with the same rows. Two versions are kept.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, path: str, keys=()):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.folder = Folder(spark, self.path)

    def _versions(self) -> list[int]:
        numbers = [int(n.removeprefix("batch=")) for n in self.folder.names() if n.startswith("batch=")]
        return sorted(n for n in numbers if self.folder.exists(f"batch={n}/_SUCCESS"))

    def before(self, batch_id: int, schema) -> DataFrame:
        earlier = [n for n in self._versions() if n < batch_id]
        return self._read(earlier[-1], schema) if earlier else self.spark.createDataFrame([], schema)

    def latest(self, schema) -> DataFrame:
        return self.before(1 << 62, schema)

    def start_from(self, savepoint: "VersionedTable", schema) -> None:
        """Take over the rows of another job's table, to be found by the first batch of this one."""
        self.write(-1, savepoint.latest(schema))

    def put(self, batch_id: int, changed: DataFrame) -> None:
        """Write the version of this batch: that before it with the rows of ``changed`` in place of those of the same ``keys``."""
        old = self.before(batch_id, changed.schema)
        same = [old[k].eqNullSafe(changed[k]) for k in self.keys]
        self.write(batch_id, old.join(changed, same, "anti").unionByName(changed))

    def _read(self, number: int, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch={number}")

    def write(self, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        for old in self._versions()[: -self.KEPT]:
            if old < batch_id:
                self.folder.delete(f"batch={old}")


class BatchOutput:
    """The output rows of a stream, one folder per batch; running a batch again overwrites its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, schema) -> DataFrame:
        """All rows, with the number of the batch that wrote them."""
        names = [n for n in Folder(self.spark, self.path).names() if n.startswith("batch=")]
        if not names:
            return self.spark.createDataFrame([], f"{schema}, batch int")
        return self.spark.read.schema(f"{schema}, batch int").parquet(self.path)


def drain(stream: DataFrame, label: str, checkpoint: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over all there is, in append mode, and return the rows it wrote.

    ``by`` writes each value of a column, such as the tag of a side output, to a folder of its own.
    """
    spark = use_rocksdb(stream.sparkSession)
    out = new_dir(spark, label)
    writer = stream.writeStream.outputMode("append").trigger(availableNow=True)
    writer = writer.option("checkpointLocation", checkpoint or f"{out}/checkpoint")
    if by:
        writer = writer.partitionBy(*by)
    finish(writer.format("parquet").option("path", f"{out}/rows").start())
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def run_batches(stream: DataFrame, body, checkpoint: str, mode: str = "append") -> None:
    """Give every batch of the stream to ``body(batch, batch_id)``."""
    use_rocksdb(stream.sparkSession)
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    finish(writer.foreachBatch(body).start())


def finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query
