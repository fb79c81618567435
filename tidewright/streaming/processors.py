"""Keyed state with ``transformWithState``: a row out for every row in.

For operators whose state goes beyond an aggregate. The rows of a key in a batch come as a sequence
of Arrow batches; state is read and written once per key and batch, and the rows in between are
computed with vectorised pandas. How many rows a batch holds is set at the source. Where a running
aggregate is all that is needed, ``streaming.changelog`` also spreads a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.session import use_rocksdb


class RunningSum(StatefulProcessor):
    """The sum per key in a value state. Input ``key, value``; output ``key, value, running``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.total.get()[0] if self.total.exists() else 0
        for pdf in rows:
            running = held + pdf["value"].cumsum()
            held = int(running.iloc[-1])
            yield pd.DataFrame({"key": key[0], "value": pdf["value"], "running": running})
        self.total.update((held,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """Start from the sums of another query, such as one with a different number of partitions."""
        self.total.update((int(initialState["total"].iloc[0]),))

    def close(self) -> None:
        pass


class ExpiringCount(StatefulProcessor):
    """Counts that start again after a silence of ``ttl_ms``: every write renews the time to live."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "count bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.count.get()[0] if self.count.exists() else 0
        for pdf in rows:
            numbers = range(held + 1, held + len(pdf) + 1)
            held += len(pdf)
            yield pd.DataFrame({"key": key[0], "count": numbers})
        self.count.update((held,))

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """Every ``slide`` rows of a key, the sum of the last ``size`` rows; tumbling if they are equal."""

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen bigint")
        self.last = handle.getListState("last", "value bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = self.seen.get()[0] if self.seen.exists() else 0
        last = [v[0] for v in self.last.get()]
        for pdf in rows:
            values = pd.Series(last + pdf["value"].tolist(), dtype="int64")
            so_far = values.cumsum()
            sums = so_far - so_far.shift(self.size, fill_value=0)
            numbers = pd.Series(range(seen - len(last) + 1, seen + len(pdf) + 1))
            fires = (numbers > seen) & (numbers % self.slide == 0)
            seen += len(pdf)
            last = values.tail(self.size - 1).tolist() if self.size > 1 else []
            yield pd.DataFrame({"key": key[0], "rn": numbers[fires], "sum": sums[fires]})
        self.seen.update((seen,))
        if last:
            self.last.put([(int(v),) for v in last])

    def close(self) -> None:
        pass


class LatestValue(StatefulProcessor):
    """The last value of each key, kept for lookup from outside."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "value bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        value = None
        for pdf in rows:
            value = int(pdf["value"].iloc[-1])
        if value is not None:
            self.latest.update((value,))
            yield pd.DataFrame({"key": [key[0]], "value": [value]})

    def close(self) -> None:
        pass


def with_state(stream: DataFrame, key: str, processor: StatefulProcessor, schema: str,
               time_mode: str = "None", initial: DataFrame | None = None) -> DataFrame:
    """Apply a processor per key. ``initial`` holds one row of earlier state per key."""
    use_rocksdb(stream.sparkSession)
    return stream.groupBy(key).transformWithStateInPandas(
        processor, schema, "Update", time_mode, initial.groupBy(key) if initial is not None else None
    )
