"""Session settings and the shared folder every job writes its working files to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: UTC, so that time text and windows agree everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """State larger than the heap, and a requirement of ``transformWithState``."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """The single-machine session of the tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewright-"))
    return context.getCheckpointDir().rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path of its own for one run, inside the shared folder."""
    return f"{shared_dir(spark)}/tidewright/{label}-{uuid.uuid4().hex}"


#: Shuffle files go when the execution that wrote them ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions inside remove their shuffle files at their end; the session's own setting holds again afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, label: str = "rows") -> DataFrame:
    """Compute ``df`` once, into a table of the shared folder; it outlives the executors that wrote it."""
    path = new_dir(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows.written_to = path
    return rows


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialise` wrote, once what was computed from them is written itself."""
    for rows in tables:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(rows.written_to)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
