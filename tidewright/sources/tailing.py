"""A stream of the lines of growing files, with a byte offset for each file in the checkpoint.

The file source of Spark reads a file once. Here a batch is what has been appended since the last, up to the last line break, so
files may grow and a line that is still being written waits. Long stretches are cut by bytes and read by many tasks; a
line belongs to the task in whose stretch it begins. Offsets are a pure function of the files, so a batch that failed is planned
again with the same ends and no line is lost or read twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that a task reads at a time, and rows of its batches.
CHUNK, ROWS = 1 << 20, 10_000


@dataclass
class Stretch(InputPartition):
    """Bytes of a file. ``first`` says that a line begins at ``begin``."""

    file: str
    begin: int
    end: int
    first: bool


def stretches(start: dict[str, int], end: dict[str, int], size: int) -> list[Stretch]:
    """What has come between two offsets, in stretches of at most ``size`` bytes."""
    out = []
    for file, stop in sorted(end.items()):
        at = start.get(file, 0)
        if stop < at:
            raise ValueError(f"{file} has shrunk from {at} to {stop} bytes; a tailed file only grows")
        out += [Stretch(file, b, min(b + size, stop), b == at) for b in range(at, stop, size)]
    return out


def lines_of(file, part: Stretch, stop: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines that begin in a stretch; the last one may end after it, but before ``stop``."""
    file.seek(part.begin if part.first else part.begin - 1)
    place = file.tell()
    held, skip = b"", not part.first  # one byte earlier: a line break there means that a line begins at ``begin``
    while place < part.end or held or skip:
        data = file.read(min(CHUNK, stop - place - len(held)))
        if not data:
            break
        pieces = (held + data).split(b"\n")
        held = pieces.pop()
        for piece in pieces:
            if skip:
                skip = False
            elif place < part.end:
                yield place, piece
            else:
                return
            place += len(piece) + 1
        if place >= part.end and not skip:
            return


class TailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("bytesPerTask", 32 << 20))

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def _after_last_break(self, files, file: str, size: int) -> int:
        """The place after the last line break of a file."""
        with files.open_input_file(file) as source:
            at = size
            while at:
                begin = max(0, at - CHUNK)
                source.seek(begin)
                found = source.read(at - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                at = begin
        return 0

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        files, base = self._open()
        found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
        names = [(f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
        ends = {path.rsplit("/", 1)[-1]: self._after_last_break(files, path, size) for path, size in names}
        return {name: end for name, end in sorted(ends.items()) if end}

    def partitions(self, start: dict, end: dict) -> list:
        return stretches(start, end, self.size) or [Stretch("", 0, 0, True)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition.begin == partition.end:
            return
        files, base = self._open()
        held: list[tuple[int, bytes]] = []

        def batch():
            places, values = zip(*held, strict=True)
            text = [v.decode("utf-8", "replace") for v in values]
            return pa.RecordBatch.from_arrays([pa.array([partition.file] * len(held)), pa.array(places, pa.int64()), pa.array(text)], names=["file", "place", "value"])

        with files.open_input_file(f"{base}/{partition.file}") as source:
            size = 0
            for place, value in lines_of(source, partition, source.size()):
                held.append((place, value))
                size += len(value)
                if len(held) == ROWS or size > CHUNK:
                    yield batch()
                    held, size = [], 0
            if held:
                yield batch()

    def commit(self, end) -> None:
        pass


class LineTail(DataSource):
    """Options: ``path``, a folder that tasks can reach, and ``bytesPerTask``."""

    @classmethod
    def name(cls):
        return "line_tail"

    def schema(self):
        return "file string, place bigint, value string"

    def streamReader(self, schema):
        return TailReader(self.options)


def line_tail(spark: SparkSession, folder: str, bytes_per_task: int = 32 << 20) -> DataFrame:
    """``file``, ``place`` (byte offset) and ``value`` of each line of the files of a folder, as they grow.

    Hidden files and those whose name begins with ``_`` are left out. The offsets of all files are in each batch's log, so this
    is for files that grow; for ever more files there is ``streams.file_tail``. A batch is all there is when it begins.
    """
    spark.dataSource.register(LineTail)
    return spark.readStream.format("line_tail").option("path", folder).option("bytesPerTask", bytes_per_task).load()
