"""Windows with allowed lateness as a stateful operator: event-time timers fire, fire again and drop state.

A window ``[start, end)`` of a key is a group of its own with two timers, one at its end and one at its end plus the
lateness. State is a count and whether the window has fired, so a batch reads and writes only the windows it touches, and a
window whose second timer has gone holds nothing. Structured Streaming drops late rows before a stateful operator if
they carry the time of the watermark; here they carry plain numbers, so late rows come out under a tag instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.operators.eventtime import window_end
from tidewright.session import use_rocksdb

FIRINGS = "key string, window_end bigint, tag string, seq bigint, n bigint"


class FiringWindow(StatefulProcessor):
    """One key and window. Input ``key, window_end, seq``; output ``key, window_end, tag, seq, n``.

    ``first``: the count when the watermark reaches the end. ``refire``: the count after the rows of a later batch that
    come within the lateness, with the highest ``seq`` of them. ``late``: each row after that. ``untimed``: each row
    without a time.
    """

    def __init__(self, lateness_ms: int):
        self.lateness_ms = lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # key and window are kept with the count: the key handed to an expired timer may lack its numbers
        self.held = handle.getValueState("held", "key string, window_end bigint, n bigint, fired boolean")

    @staticmethod
    def _out(key, tag: str, seqs, counts) -> pd.DataFrame:
        n = len(seqs)
        end = None if key[1] is None or pd.isna(key[1]) else int(key[1])
        return pd.DataFrame({
            "key": pd.Series([key[0]] * n, dtype=object), "window_end": pd.array([end] * n, "Int64"), "tag": [tag] * n,
            "seq": pd.array(seqs, "Int64"), "n": pd.array(counts, "Int64"),
        })

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1] is None or pd.isna(key[1]):
            for part in rows:
                yield self._out(key, "untimed", part["seq"].tolist(), [None] * len(part))
            return
        end, now = int(key[1]), timerValues.getCurrentWatermarkInMs()
        if now and now >= end + self.lateness_ms:
            for part in rows:
                yield self._out(key, "late", part["seq"].tolist(), [None] * len(part))
            return
        known = self.held.exists()
        n, fired = self.held.get()[2:] if known else (0, False)
        reached = bool(now) and now >= end
        if reached and known and not fired:  # rows are handled before timers, so this firing would miss its turn
            yield self._out(key, "first", [None], [n])
        last = None
        for part in rows:
            n += len(part)
            seq = part["seq"].max()
            last = last if pd.isna(seq) else int(seq) if last is None else max(last, int(seq))
        if reached:
            yield self._out(key, "refire", [last], [n])
        if not known:
            for at in {end, end + self.lateness_ms} if not reached else {end + self.lateness_ms}:
                self.handle.registerTimer(at)
        self.held.update((key[0], end, int(n), reached))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.held.exists():
            return
        *own, n, fired = self.held.get()
        if not fired:
            yield self._out(own, "first", [None], [n])
            self.held.update((*own, n, True))
        if expiredTimerInfo.getExpiryTimeInMs() >= own[1] + self.lateness_ms:
            self.held.clear()

    def close(self) -> None:
        pass


def firing_windows(stream: DataFrame, key: str, time: str, seq: str, size_ms: int, bound_ms: int, lateness_ms: int) -> DataFrame:
    """Firings, late and untimed rows of a stream: ``key, window_end, tag, seq, n``.

    ``time`` is epoch milliseconds. The watermark is the highest time of the batches before, less ``bound_ms``; with one row
    a batch the result is that of ``operators.eventtime.with_lateness``. The rows of a window in a batch are one task's.
    """
    use_rocksdb(stream.sparkSession)
    t = F.col(time).cast("long")
    timed = stream.withColumn("__at", F.timestamp_millis(t)).withWatermark("__at", f"{bound_ms} milliseconds")
    rows = timed.select(F.col(key).cast("string").alias("key"), window_end(t, size_ms).alias("window_end"), F.col(seq).cast("long").alias("seq"))
    return rows.groupBy("key", "window_end").transformWithStateInPandas(FiringWindow(lateness_ms), FIRINGS, "Append", "EventTime")


class SilentKey(StatefulProcessor):
    """Counts of a key that start anew after a silence. Input ``key, t, seq`` (t in microseconds); output ``key, seq, count``.

    A timer a silence after the last row drops the state; it moves with every batch that has rows of the key.
    """

    def __init__(self, silence: int):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "n bigint, last bigint")

    def _timer(self, last: int) -> int:
        return -(-(last + self.silence) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["t", "seq"], kind="stable")
        n, last = self.held.get() if self.held.exists() else (0, None)
        gap = batch["t"].diff()
        anew = gap >= self.silence
        anew.iloc[0] = last is None or int(batch["t"].iloc[0]) - last >= self.silence
        run = anew.cumsum()
        count = batch.groupby(run).cumcount() + 1
        count = count.where(run > 0, count + n)
        if last is not None:
            self.handle.deleteTimer(self._timer(last))
        last = max(int(batch["t"].iloc[-1]), last if last is not None else int(batch["t"].iloc[-1]))
        self.held.update((int(count.iloc[-1]), last))
        self.handle.registerTimer(self._timer(last))
        yield pd.DataFrame({"key": pd.Series([key[0]] * len(batch), dtype=object), "seq": batch["seq"].to_numpy(), "count": count.to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        yield from ()

    def close(self) -> None:
        pass


def expiring_counts(stream: DataFrame, key: str, time: str, seq: str, silence_seconds: int, bound: str = "0 seconds") -> DataFrame:
    """``key``, ``seq`` and ``count``: the running count of each key, which starts anew after a silence of event time.

    ``time`` is in microseconds. Rows come in the order of their time over batches, and are put in order by time and ``seq``
    within one; the rows of a key in a batch are one task's. A key that stays silent longer has no state. This is the stream
    form of ``operators.state.expiring_counts``. Rows without a time are left out.
    """
    use_rocksdb(stream.sparkSession)
    t = F.col(time).cast("long")
    timed = stream.where(t.isNotNull()).withColumn("__at", F.timestamp_micros(t)).withWatermark("__at", bound)
    rows = timed.select(F.col(key).cast("string").alias("key"), t.alias("t"), F.col(seq).cast("long").alias("seq"))
    processor = SilentKey(silence_seconds * 1_000_000)
    return rows.groupBy("key").transformWithStateInPandas(processor, "key string, seq bigint, count bigint", "Append", "EventTime")
