"""Windows with event-time timers on a stream: against the replay form, over batches, and what state holds."""

import pytest
from pyspark.sql import functions as F

from tidewright.operators import eventtime
from tidewright.session import new_dir
from tidewright.sources.streams import arriving
from tidewright.streaming import state, timers
from tidewright.streaming.tables import drain

SIZE, BOUND, LATENESS = 5000, 3000, 2000
#: Arrivals of two keys: in order, out of order, within the lateness, too late, and without a time.
ARRIVED = [
    ("a", 1000), ("a", 2500), ("b", 4000), ("a", 8000), ("a", 3000), ("b", 9000), ("a", 4900), ("a", 12_000), ("a", 1500),
    (None, 2000), ("b", None), ("b", 13_500), ("b", 6000), ("a", 9999), ("a", 21_000), ("b", 14_999), ("b", 10_001), ("a", 19_000), ("b", 40_000),
]


def arrivals(spark):
    return spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(ARRIVED)], "k string, t long, seq long")


def run(spark, batches, checkpoint=None):
    batch = F.floor(F.col("seq") * batches / len(ARRIVED))
    stream = arriving(arrivals(spark), batch, batches)
    out = drain(timers.firing_windows(stream, "k", "t", "seq", SIZE, BOUND, LATENESS), "timers", checkpoint)
    return sorted(map(tuple, out.collect()), key=repr)


def test_one_row_a_batch_equals_the_replay(spark):
    replay = [tuple(r) for r in eventtime.with_lateness(arrivals(spark), "k", "t", "seq", SIZE, BOUND, LATENESS).collect()]
    assert ("b", None, "untimed", ARRIVED.index(("b", None)), None) in replay
    assert run(spark, len(ARRIVED)) == sorted(replay, key=repr)
    side = eventtime.late_side_output(arrivals(spark), "k", "t", "seq", SIZE, BOUND, LATENESS)
    assert {r.seq for r in side.collect()} == {r[3] for r in replay if r[2] in ("late", "untimed")}


def by_hand(batches):
    """The same rules in a loop, the watermark moving once a batch."""
    out, held, high = [], {}, None
    groups = {}
    for i, (k, t) in enumerate(ARRIVED):
        groups.setdefault(i * batches // len(ARRIVED), []).append((k, t, i))
    for rows in [*groups.values(), []]:
        now = None if high is None else high - BOUND
        fresh = {}
        for k, t, i in rows:
            if t is None:
                out.append((k, None, "untimed", i, None))
                continue
            end = (t // SIZE + 1) * SIZE
            if now is not None and now >= end + LATENESS:
                out.append((k, end, "late", i, None))
            else:
                fresh.setdefault((k, end), []).append(i)
        if now is not None:
            for (k, end), w in held.items():
                if now >= end and not w[1]:
                    out.append((k, end, "first", None, w[0]))
                    w[1] = True
        for (k, end), seqs in fresh.items():
            w = held.setdefault((k, end), [0, False])
            w[0] += len(seqs)
            if now is not None and now >= end:
                out.append((k, end, "refire", max(seqs), w[0]))
                w[1] = True
        high = max([t for _, t, _ in rows if t is not None] + ([high] if high is not None else []), default=None)
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [2, 4, 7])
def test_several_rows_a_batch(spark, batches):
    assert run(spark, batches) == by_hand(batches)


def test_state_goes_when_the_second_timer_has_gone(spark):
    checkpoint = new_dir(spark, "timer-state")
    run(spark, 7, checkpoint)
    held = state.state_rows(spark, checkpoint, variable="held").select("key.*").collect()
    assert {(r.key, r.window_end) for r in held} == {("b", 45_000)}


def test_counts_expire_by_event_time(spark):
    """A count starts anew after a silence, over batches, and the state of silent keys goes."""
    hour = 3_600_000_000
    data = [("a", 0), ("a", hour), ("b", hour), ("a", 13 * hour), ("a", 13 * hour), ("c", 14 * hour), ("a", 24 * hour), ("b", 30 * hour), ("a", 36 * hour), ("c", 60 * hour), ("b", 61 * hour), ("d", 90 * hour)]
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(data)], "k string, t long, seq long")
    expected, held = [], {}
    for i, (k, t) in enumerate(data):
        n, last = held.get(k, (0, None))
        held[k] = (1 if last is None or t - last >= 12 * hour else n + 1, t)
        expected.append((k, i, held[k][0]))
    for batches in (1, 3, len(data)):
        checkpoint = new_dir(spark, "expiry")
        stream = arriving(df, F.floor(F.col("seq") * batches / len(data)), batches)
        out = drain(timers.expiring_counts(stream, "k", "t", "seq", 12 * 3600), "expiry", checkpoint)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
        kept = state.state_rows(spark, checkpoint, variable="held").select("key.*").collect()
        assert {r.key for r in kept} == {"d"}
