"""Unbounded sources: folders of files, sockets, Kafka topics, the rate source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewright.functions.text import is_blank, line
from tidewright.session import new_dir, shuffles_removed
from tidewright.streaming.tables import Folder


def glob(path: str) -> str:
    """A pattern for just this path: the file source of a stream wants a folder or a pattern."""
    return f"{path[:-1]}[{path[-1]}]"


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None, schema=None) -> DataFrame:
    """A Parquet table as a stream of its files, with the schema of the table."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(glob(path))


#: Bytes of Parquet in a file of a replayed table; a task writes one and reads one.
FILE_BYTES = 8 << 20


def arriving(df: DataFrame, batch: Column, batches: int, files: int | None = None) -> DataFrame:
    """``df`` as a stream of ``batches`` batches: ``batch``, from 0, tells when a row arrives. Batches without rows are left out.

    A row whose batch is null comes with the first, one beyond the last with the last.
    For replaying a table whose rows have an arrival order. The rows are written to the shared folder once by their batch and
    then put into the watched folder one batch after the other, each in ``files`` files; a batch of the stream is so many.
    By default there are as many as the largest batch needs for files of ``FILE_BYTES``. A batch with too few rows to fill its
    files has empty ones.
    """
    spark = df.sparkSession
    base = new_dir(spark, "arriving")
    place = F.least(F.greatest(F.coalesce(batch.cast("int"), F.lit(0)), F.lit(0)), F.lit(batches - 1))
    df.withColumn("__batch", place).write.partitionBy("__batch").parquet(f"{base}/sorted")
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__batch", T.IntegerType())])).parquet(f"{base}/sorted")
    placed, watched = Folder(spark, f"{base}/sorted"), Folder(spark, f"{base}/watched")
    sizes = {int(name.removeprefix("__batch=")): placed.size(name) for name in placed.names() if name.startswith("__batch=")}
    files = files or max(1, -(-max(sizes.values(), default=0) // FILE_BYTES))
    for done, number in enumerate(sorted(sizes), 1):
        part = rows.where(F.col("__batch") == number).drop("__batch")
        part = part.repartition(files) if files > 1 else part.coalesce(1)
        with shuffles_removed(spark):
            part.write.mode("append").parquet(watched.path)
        placed.delete(f"__batch={number}")
        for _ in range(done * files - sum(name.startswith("part-") for name in watched.names())):
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(watched.path)
    return table_stream(spark, watched.path, files, df.schema)


def text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of the files of a folder; files that come later are picked up.

    With ``availableNow`` the stream ends after the files now there (read once), with a processing
    time trigger it goes on. A file already read is not read again when it changes.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select(line(F.col("value")).alias("value"))


def file_tail(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """A file per batch, or a few, with blank lines left out."""
    return text_stream(spark, folder, files_per_batch).where(~is_blank(F.col("value")))


def socket_text(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket; for trying things out, as a socket cannot be read again."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def rate(spark: SparkSession, rows_per_second: int = 1, partitions: int = 1) -> DataFrame:
    """A counter from 0 with the time of each row."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )


START_MODES = ("latest", "earliest", "timestamp", "group")


def kafka_source_options(servers: str, topic: str, start: str = "latest", group: str | None = None,
                         start_ms: int | None = None, rows_per_batch: int | None = None) -> dict[str, str]:
    """Options of a Kafka read. Offsets are kept in the checkpoint, not in the consumer group.

    ``group`` as a start mode has no counterpart: a query that has a checkpoint goes on from it, and
    one without starts at ``latest``. New partitions are found at every batch.
    """
    if start not in START_MODES:
        raise ValueError(f"start is one of {START_MODES}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "true"}
    if start == "timestamp":
        if start_ms is None:
            raise ValueError("start='timestamp' needs start_ms")
        options["startingTimestamp"] = str(start_ms)
    else:
        options["startingOffsets"] = "latest" if start == "group" else start
    if group:
        options["kafka.group.id"] = group
    if rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    return options


def kafka_text(spark: SparkSession, **options) -> DataFrame:
    """The values of a topic as text."""
    stream = spark.readStream.format("kafka").options(**kafka_source_options(**options)).load()
    return stream.select(F.col("value").cast("string").alias("value"))
