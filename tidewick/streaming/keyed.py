"""Live context as keyed state: the last rows of every feed of a symbol, at each row of one of them.

Rows of all feeds wait until the watermark has passed them; an event-time timer at the first waiting row wakes the
symbol then. Due rows are taken in time order, so the answer does not depend on how the feeds are split into
triggers. They wait by slots of time (``SlottedRows``), each with a timer of its own: a task holds the rows of one
slot, or of one batch that arrives, however much a trigger brings. Each feed keeps its last few rows only, so a
symbol's state is bounded by these numbers and by what arrives within the delay. Rows later than the watermark are
dropped by Spark.

A symbol is worked on by one task at a time: that suits a live feed. ``ranges.ClosedRanges`` and the batch
operators work on one symbol in many tasks, for long histories.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_ROW = "time long, kind int, tie string, body string"
#: A row that only moves the watermark.
HEARTBEAT = -1
_COLUMNS = ["time", "kind", "tie", "body"]
_PART = "time array<long>, kind array<int>, tie array<string>, body array<string>"
#: Hours that a slot covers: a task holds a symbol's rows of so long a time.
SLOT_HOURS = 1
#: Rows given out at once.
_OUT_ROWS = 1000


class LastRows(StatefulProcessor):
    """State of a symbol: waiting rows, and the last ``keep[i]`` rows of feed i. Emits at each row of the last feed.

    All waiting rows are one list, which is read whole: for feeds of which few rows wait.
    """

    def __init__(self, keep: list[int]):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lists = [handle.getListState(f"feed{i}", "body string") for i in range(len(self.keep))]
        self._init_waiting()

    def _init_waiting(self) -> None:
        self.waiting = self.handle.getListState("waiting", _ROW)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for part in rows:
            part = part.loc[part["kind"] != HEARTBEAT, _COLUMNS]
            if len(part):
                self._wait(part)
        return iter(())

    def _wait(self, part: pd.DataFrame) -> None:
        self.waiting.appendList([(int(t), int(k), tie, body) for t, k, tie, body in part.itertuples(index=False, name=None)])
        self._wake(part["time"].min())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(x) for x in self.waiting.get()] if self.waiting.exists() else []
        rest = [x for x in waiting if x[0] > mark]
        if rest:
            self.waiting.put(rest)
            self._wake(min(x[0] for x in rest))
        else:
            self.waiting.clear()
        return self._given(key, sorted(x for x in waiting if x[0] <= mark))

    def _given(self, key: Any, due: list[tuple]) -> Iterator[pd.DataFrame]:
        """The output of rows in their order; each feed's last rows move on."""
        if not due:
            return
        lists = [[x[0] for x in state.get()] if state.exists() else [] for state in self.lists]
        out = []
        for time, kind, _, body in due:
            lists[kind] = (lists[kind] + [body])[-self.keep[kind]:]
            if kind == len(self.keep) - 1:
                out.append((key[0], time, [list(x) for x in lists]))
            if len(out) == _OUT_ROWS:
                yield pd.DataFrame(out, columns=["key", "time", "lists"])
                out = []
        for state, bodies in zip(self.lists, lists):
            state.put([(x,) for x in bodies]) if bodies else state.clear()
        if out:
            yield pd.DataFrame(out, columns=["key", "time", "lists"])

    def _wake(self, time: int) -> None:
        self.handle.registerTimer(-(-int(time) // 1000))

    def close(self) -> None:
        pass


class SlottedRows(LastRows):
    """Rows wait by slots of ``hours``, in the parts they came in, and only a slot that is due is read.

    Timers come in time order, and the timer of a row lies in the row's slot: a slot ends at a whole millisecond, which
    belongs to it. Of several timers of a slot the first takes all that is due in it.
    """

    def __init__(self, keep: list[int], hours: int = SLOT_HOURS):
        super().__init__(keep)
        self.width = hours * 3_600_000_000

    def _init_waiting(self) -> None:
        self.waiting = self.handle.getMapState("waiting", "slot long, part int", _PART)
        self.parts = self.handle.getMapState("parts", "slot long", "n int")

    def _wait(self, part: pd.DataFrame) -> None:
        for slot, rows in part.groupby((part["time"] - 1) // self.width):
            slot = int(slot)
            n = self.parts.getValue((slot,))[0] if self.parts.containsKey((slot,)) else 0
            self.waiting.updateValue((slot, n), tuple(rows[c].tolist() for c in _COLUMNS))
            self.parts.updateValue((slot,), (n + 1,))
            self._wake(rows["time"].min())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        slot = (expiredTimerInfo.getExpiryTimeInMs() * 1000 - 1) // self.width
        if not self.parts.containsKey((slot,)):  # an earlier timer took the rows
            return
        waiting = []
        for n in range(self.parts.getValue((slot,))[0]):
            waiting.extend(zip(*self.waiting.getValue((slot, n))))
            self.waiting.removeKey((slot, n))
        self.parts.removeKey((slot,))
        rest = [x for x in waiting if x[0] > mark]
        if rest:
            self._wait(pd.DataFrame(rest, columns=_COLUMNS))
        yield from self._given(key, sorted(x for x in waiting if x[0] <= mark))


def feed_rows(df: DataFrame, kind: int, *, time: str = "timestamp", tie: str | None = None, key: str = "symbol") -> DataFrame:
    """(key, at, kind, tie, body) of a feed, for ``last_rows``; rows without a key or a time are left out."""
    order = F.lit("") if tie is None else F.format_string("%020d", F.col(tie))
    return df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("key"), F.col(time).alias("at"), F.lit(kind).alias("kind"), order.alias("tie"),
        F.to_json(F.struct("*")).alias("body"))


def last_rows(feeds: Mapping[str, DataFrame], base: str, keep: Mapping[str, int], delay: str, *, ties: Mapping[str, str] | None = None,
              times: Mapping[str, str] | None = None, heartbeats: DataFrame | None = None, slot_hours: int = SLOT_HOURS) -> DataFrame:
    """A stream of (key, at, <feed> arrays): at each ``base`` row, the last ``keep`` rows of every feed, oldest first.

    Of equal times the base comes last, and other feeds in their order. A base row is its own last base row.
    ``heartbeats`` (symbol, timestamp) are rows that only move the watermark, as at the end of a feed. A symbol's rows of
    ``slot_hours`` should fit a task; fewer slots cost less for sparse feeds. Needs the RocksDB state store
    (``with_state_store``).
    """
    names = [x for x in feeds if x != base] + [base]
    parts = [feed_rows(feeds[x], i, time=(times or {}).get(x, "timestamp"), tie=(ties or {}).get(x)) for i, x in enumerate(names)]
    if heartbeats is not None:
        parts.append(feed_rows(heartbeats, HEARTBEAT))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    out = (rows.withWatermark("at", delay).withColumn("time", F.unix_micros("at")).groupBy("key").transformWithStateInPandas(
        SlottedRows([keep[x] for x in names], slot_hours), outputStructType="key string, time long, lists array<array<string>>",
        outputMode="append", timeMode="eventTime"))
    def read(number: int, like: DataFrame) -> Column:
        return F.transform(F.col("lists")[number], lambda body: F.from_json(body, like.schema))

    return out.select("key", F.timestamp_micros("time").alias("at"), *[read(i, feeds[x]).alias(x) for i, x in enumerate(names)])


def with_state_store(spark: SparkSession) -> SparkSession:
    """Selects the state store that keyed state needs; a stream takes it when it starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark
