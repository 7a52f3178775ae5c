"""State that ends by itself (X06): sessions closed by event-time timers.

Per run the state holds its open sessions only.  A row extends, bridges or opens a session; a
timer stands at the end of the run's earliest one.  When the watermark reaches it, the ended
sessions are emitted once, their state is freed and the next timer is set.  Rows later than the
watermark are dropped before.  State is read and written per run, not per session: each call
to the state store is a round trip between Python and the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .ops import utc_instant

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merge_sessions(spans: list[tuple], gap: int) -> list[tuple]:
    """(first, last, n, total) spans joined where the next begins less than ``gap`` after the
    last moment of the one before."""
    out: list[tuple] = []
    for first, last, n, total in sorted(spans):
        if out and first - out[-1][1] < gap:
            a = out[-1]
            out[-1] = (a[0], max(a[1], last), a[2] + n, a[3] + total)
        else:
            out.append((first, last, n, total))
    return out


class SessionTimers(StatefulProcessor):
    """Sessions of one key; times in microseconds, timers in milliseconds."""

    def __init__(self, key: str, gap_us: int):
        self.key, self.gap = key, gap_us

    def init(self, handle) -> None:
        self.handle = handle
        # one value a run, in columns: a row of state costs a conversion in Python and one in the JVM
        kind = "first array<long>, last array<long>, n array<long>, total array<double>"
        self.open = handle.getValueState("open", kind)

    def _due(self, last: int) -> int:
        return -(-(last + self.gap) // 1000)

    def _held(self) -> list[tuple]:
        held = self.open.get()
        return list(zip(*held)) if held else []

    def _keep(self, sessions: list[tuple]) -> None:
        if sessions:
            self.open.update(tuple(list(c) for c in zip(*sessions)))
        else:
            self.open.clear()

    def _first_due(self, sessions: list[tuple]) -> int:
        return self._due(sessions[0][1])  # they are apart and in order, so the first ends first

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np

        before = self._held()
        spans = before
        for pdf in rows:  # the rows of a chunk are cut at their gaps at once
            at, x = pdf["us_"].to_numpy(), pdf["value_"].to_numpy(dtype="float64")
            order = np.argsort(at, kind="stable")
            at, x = at[order], np.nan_to_num(x[order], nan=0.0, posinf=np.inf, neginf=-np.inf)
            lo = np.concatenate([[0], np.flatnonzero(np.diff(at) >= self.gap) + 1])
            hi = np.append(lo[1:], len(at))
            new = zip(map(int, at[lo]), map(int, at[hi - 1]), (hi - lo).tolist(), np.add.reduceat(x, lo).tolist())
            spans = merge_sessions([*spans, *new], self.gap)
        if spans != before:
            self._keep(spans)
        # open sessions have a timer no later than the end of the first, and rows only delay an end
        if not before or self._first_due(spans) < self._first_due(before):
            self.handle.registerTimer(self._first_due(spans))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        now = timerValues.getCurrentWatermarkInMs()
        held = self._held()
        n = sum(self._due(s[1]) <= now for s in held)  # an extended session ends later than its timer
        if n:
            self._keep(held[n:])
        if held[n:]:
            self.handle.registerTimer(self._first_due(held[n:]))
        if n:
            rows = [(key[0], a, b + self.gap, c, t) for a, b, c, t in held[:n]]
            yield pd.DataFrame(rows, columns=[self.key, "session_start_us", "session_end_us", "n_events", "total"])

    def close(self) -> None:
        pass


def closed_sessions(events: DataFrame, ts: str, key: str, gap_seconds: int, value: str, watermark: str) -> DataFrame:
    """X06 in append mode: each session once, when the watermark passes its end.  Needs the
    RocksDB state store (``rocksdb_state``)."""
    # no leading underscores: the state function's rows pass through named tuples
    e = events.select(F.col(key), utc_instant(ts).alias("ts_"), F.col(value).cast("double").alias("value_"))
    e = e.withColumn("us_", F.unix_micros("ts_")).withWatermark("ts_", watermark)
    kind = events.schema[key].dataType.simpleString()
    return e.groupBy(key).transformWithStateInPandas(
        SessionTimers(key, gap_seconds * 1_000_000),
        outputStructType=f"{key} {kind}, session_start_us long, session_end_us long, n_events long, total double",
        outputMode="Append", timeMode="EventTime")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The state store that timers and composite state need, for queries started inside."""
    old = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, old) if old else spark.conf.unset(STATE_STORE)
