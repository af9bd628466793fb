"""Live stall flags: a key that falls silent is told of without a new event.

State is the last time of each key; two timers stand at its slow and its stalled time. A timer that comes
due while nothing newer has arrived raises its flag, in append mode. With event time the watermark moves the timers (a drained
backlog gives what a batch query gives); with processing time the clock does, for a live stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds of silence after which a key is slow, and stalled.
SLOW, STALLED = 240, 900
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_timers(spark: SparkSession) -> SparkSession:
    """The session, set to the state provider that timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


def _silence(key_: str, limits_: list[tuple[int, str]], live_: bool) -> StatefulProcessor:
    """The processor of a stream; made here, so that it travels by value and the state's worker needs no package."""

    class Silence(StatefulProcessor):
        """Emits (key, flag, last event) when a key's silence reaches a limit."""

        def __init__(self, key: str, limits: list[tuple[int, str]], live: bool):
            self.key, self.limits, self.live = key, sorted(limits), live

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "stamp long, told int")

        def _frame(self, key: tuple, rows: list[tuple[str, int]]) -> pd.DataFrame:
            columns = {self.key: pd.Series([key[0]] * len(rows), dtype=object), "flag": pd.Series([r[0] for r in rows], dtype=object)}
            return pd.DataFrame(columns | {"last_event": pd.to_datetime(pd.Series([r[1] for r in rows], dtype="int64"), unit="us")})

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            stamps = sorted(int(t) for part in rows if len(part) for t in part["micros"])
            last, told = self.last.get() if self.last.exists() else (None, 0)
            before, flags = last, []
            for t in stamps:
                if last is not None and t > last:
                    # what timers have told of this silence isn't told again; a live key's silence is the timers' alone
                    reached = [] if self.live else [name for s, name in self.limits if t - last >= s * 1_000_000]
                    flags += [(name, last) for name in reached[told:]]
                    told = 0
                last = t if last is None else max(last, t)
            if last != before:
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                now = timerValues.getCurrentProcessingTimeInMs() if self.live else -(-last // 1000)
                for s, _ in self.limits:
                    self.handle.registerTimer(now + s * 1000)
                self.last.update((last, 0))
            if flags:
                yield self._frame(key, flags)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            last, told = self.last.get()
            if told < len(self.limits):  # timers come due in their order
                self.last.update((last, told + 1))
                yield self._frame(key, [(self.limits[told][1], last)])

        def close(self) -> None:
            pass

    return Silence(key_, limits_, live_)


def stall_flags(events: DataFrame, stamp: str, key: str, delay: str = "1 hour", live: bool = False, slow: int = SLOW, stalled: int = STALLED) -> DataFrame:
    """``key``, flag (``slow``, ``stalled``), last_event: one row each time a key has been silent so long.

    Events that come out of order within the delay don't move a key's last time back. Rows without a key or time are left out.
    The session needs the state provider that :func:`with_timers` sets.
    """
    rows = events.where(F.col(key).isNotNull() & F.col(stamp).isNotNull()).select(key, stamp, F.unix_micros(F.col(stamp).cast("timestamp")).alias("micros"))
    if not live:
        rows = rows.withWatermark(stamp, delay)
    schema = f"{key} {events.schema[key].dataType.simpleString()}, flag string, last_event timestamp"
    return rows.groupBy(key).transformWithStateInPandas(_silence(key, [(slow, "slow"), (stalled, "stalled")], live), schema, "Append", "ProcessingTime" if live else "EventTime")
