"""A user-written sink that is transactional: files of rows, and a list of those that count.

Tasks write files with names of their own and hand their names on as commit messages. The driver commits by writing one list
of names, in one step; a reader takes only listed files. So a task that was killed or ran twice, and a job or batch that was
aborted, leave no rows, whatever files they leave; an abort removes those it knows of. A batch of a stream has a list named
after its number, and a batch run again writes that list again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

#: The folder of the lists, and rows of a block of lines.
COMMITS, ROWS = "_commits", 10_000


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, None if it had no rows, and how many rows are in it."""

    file: str | None
    rows: int


@dataclass
class ListedFile(InputPartition):
    name: str


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class Formatter:
    """What a user changes: ``open`` once per task, ``line`` per row, ``close`` at the end whatever happened."""

    def open(self, partition: int) -> None:
        self.prefix = f"{partition + 1}> "

    def line(self, row) -> str:
        return self.prefix + ",".join("" if v is None else str(v) for v in row)

    def close(self) -> None:
        pass


class TupleFormatter(Formatter):
    """A row as text, such as ``(word,2)``."""

    def open(self, partition: int) -> None:
        pass

    def line(self, row) -> str:
        return f"({','.join('' if v is None else str(v) for v in row)})"


class _Writing:
    """Shared by the batch and the stream writer."""

    def __init__(self, path: str, formatter: Formatter):
        self.path, self.formatter = path, formatter

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        files, base = _open(self.path)
        files.create_dir(base, recursive=True)
        partition = TaskContext.get().partitionId()
        name, rows, held = f"part-{partition:05d}-{uuid.uuid4().hex}.txt", 0, []
        self.formatter.open(partition)
        try:
            with files.open_output_stream(f"{base}/{name}") as out:
                for row in iterator:
                    held.append(self.formatter.line(row).replace("\n", " "))
                    rows += 1
                    if len(held) == ROWS:
                        out.write(("\n".join(held) + "\n").encode())
                        held = []
                if held:
                    out.write(("\n".join(held) + "\n").encode())
        except BaseException:
            files.delete_file(f"{base}/{name}")
            raise
        finally:
            self.formatter.close()
        if not rows:
            files.delete_file(f"{base}/{name}")
        return Written(name if rows else None, rows)

    def _commit(self, label: str, messages) -> None:
        files, base = _open(self.path)
        files.create_dir(f"{base}/{COMMITS}", recursive=True)
        listed = {m.file: m.rows for m in messages if m is not None and m.file}
        temporary = f"{base}/{COMMITS}/_{uuid.uuid4().hex}"
        with files.open_output_stream(temporary) as out:
            out.write(json.dumps(listed).encode())
        files.move(temporary, f"{base}/{COMMITS}/{label}")

    def _abort(self, messages) -> None:
        from pyarrow import fs

        files, base = _open(self.path)
        for message in messages:
            if message is not None and message.file and files.get_file_info(f"{base}/{message.file}").type == fs.FileType.File:
                files.delete_file(f"{base}/{message.file}")


class BatchWriter(_Writing, DataSourceWriter):
    def commit(self, messages) -> None:
        self._commit(f"job-{uuid.uuid4().hex}", messages)

    def abort(self, messages) -> None:
        self._abort(messages)


class StreamWriter(_Writing, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(f"batch-{batchId}", messages)

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class ListedReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list:
        return [ListedFile(name) for name in committed(self.path)] or [ListedFile("")]

    def read(self, partition: ListedFile) -> Iterator[tuple]:
        if partition.name:
            files, base = _open(self.path)
            with files.open_input_stream(f"{base}/{partition.name}") as source:
                held = b""
                while block := source.read(1 << 20):
                    *lines, held = (held + block).split(b"\n")
                    for line in lines:
                        yield (line.decode(),)


def committed(path: str) -> dict[str, int]:
    """The files that count, with their rows."""
    from pyarrow import fs

    files, base = _open(path)
    listed: dict[str, int] = {}
    for info in files.get_file_info(fs.FileSelector(f"{base}/{COMMITS}", allow_not_found=True)):
        if not info.base_name.startswith("_"):
            with files.open_input_stream(info.path) as source:
                listed |= json.loads(source.read())
    return listed


class CommittedLines(DataSource):
    """Option ``path``: a folder all tasks can reach."""

    formatter: Callable[[], Formatter] = Formatter

    @classmethod
    def name(cls):
        return "committed_lines"

    def schema(self):
        return "value string"

    def reader(self, schema):
        return ListedReader(self.options["path"])

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("rows are appended")
        return BatchWriter(self.options["path"], type(self).formatter())

    def streamWriter(self, schema, overwrite):
        return StreamWriter(self.options["path"], type(self).formatter())


def remove_unlisted(path: str) -> int:
    """Delete what killed tasks and aborted jobs have left; not while something is being written. Returns how many files went."""
    from pyarrow import fs

    files, base = _open(path)
    listed = committed(path)
    found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
    left = [f.path for f in found if f.type == fs.FileType.File and f.base_name.startswith("part-") and f.base_name not in listed]
    for name in left:
        files.delete_file(name)
    return len(left)


def register(spark: SparkSession, formatter: type[Formatter] = Formatter) -> str:
    """Register the sink with a user's formatter; returns its format name."""
    kind = type("CommittedLines", (CommittedLines,), {"formatter": formatter})
    spark.dataSource.register(kind)
    return kind.name()


def write_lines(df: DataFrame, path: str, formatter: type[Formatter] = Formatter) -> None:
    """Append the rows of ``df`` as lines, all or none."""
    df.write.format(register(df.sparkSession, formatter)).option("path", path).mode("append").save()


def stream_lines(stream: DataFrame, path: str, checkpoint: str, formatter: type[Formatter] = Formatter) -> DataStreamWriter:
    """The rows of each batch as lines, each batch once."""
    writer = stream.writeStream.format(register(stream.sparkSession, formatter)).option("path", path)
    return writer.option("checkpointLocation", checkpoint)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines of all that was committed."""
    return spark.read.format(register(spark)).option("path", path).load()
