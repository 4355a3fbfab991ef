"""T4: lag features on a stream, with state that ends.

Each trip-day is a key with two list states: ``waiting``, observations the watermark hasn't passed, and
``tail``, the last ``depth - 1`` emitted ones. Rows may arrive in any order within the watermark's
delay and over any number of micro-batches: they wait, an event-time timer is set for the
youngest of a batch, and when the watermark passes it all rows up to the watermark are emitted in
(timestamp, id) order, with the same features as the batch window (W2-W4) over tail and rows. A
second timer stands at the end of the trip-day: nothing can follow it, so the key's state is
dropped. Rows older than the watermark are dropped by Spark (and counted in its progress report).

A bounded replay ends with one row of trip ``END_TRIP`` far enough behind the last day; it moves the
watermark and is left out before the state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.features import AVG_FEATURES, TRIP_DAY

INT_FEATURES = {"delay", "occupancy_status"}
END_TRIP = "__end_of_stream__"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DEPTH = 10
MEANS = (5, 10)


def output_schema(cols=AVG_FEATURES) -> T.StructType:
    f = [T.StructField("id", T.LongType()), T.StructField("timestamp", T.LongType())]
    for c in cols:
        f.append(T.StructField(f"1_lag_{c}", T.IntegerType() if c in INT_FEATURES else T.DoubleType()))
    for n in MEANS:
        for c in cols:
            f.append(T.StructField(f"{n}_lag_{c}_avg", T.DoubleType()))
    return T.StructType(f)


def state_schema(cols=AVG_FEATURES) -> T.StructType:
    return T.StructType([T.StructField("timestamp", T.LongType()), T.StructField("id", T.LongType())]
                        + [T.StructField(f"v_{c}", T.DoubleType()) for c in cols])


def day_end_ms(day: int, month: int, year: int, tz: str) -> int:
    """Epoch milliseconds at which a local day is over."""
    after = dt.datetime.combine(dt.date(year, month, day) + dt.timedelta(days=1), dt.time(0), ZoneInfo(tz))
    return int(after.timestamp() * 1000)


def lag_row(run: list[tuple], i: int, names: list[str], cols) -> Row:
    """The features of run[i] (timestamp, id, values...) from the rows before it."""
    out = [run[i][1], run[i][0]]
    for k, c in enumerate(cols, 2):
        v = run[i - 1][k] if i else None
        out.append(int(v) if v is not None and c in INT_FEATURES else v)
    for n in MEANS:
        for k in range(2, 2 + len(cols)):
            known = [r[k] for r in run[max(0, i - n + 1):i + 1] if r[k] is not None]
            out.append(sum(known) / len(known) if known else None)
    return Row(**dict(zip(names, out, strict=True)))


class TripDayLags(StatefulProcessor):
    def __init__(self, cols=AVG_FEATURES, tz: str = "UTC"):
        self.cols, self.tz = list(cols), tz
        self.names = output_schema(cols).names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", state_schema(self.cols))
        self.tail = handle.getListState("tail", state_schema(self.cols))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = [(r["timestamp"], r["id"], *[None if r[c] is None else float(r[c]) for c in self.cols]) for r in rows]
        self.waiting.appendList(fresh)
        self.handle.registerTimer(max(r[0] for r in fresh) * 1000)
        self.handle.registerTimer(day_end_ms(*key[1:4], self.tz))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = [tuple(r) for r in self.waiting.get()]
        ready = sorted((r for r in held if r[0] * 1000 <= mark), key=lambda r: r[:2])
        tail = [tuple(r) for r in self.tail.get()]
        run = tail + ready
        if mark >= day_end_ms(*key[1:4], self.tz):
            self.waiting.clear()
            self.tail.clear()
        elif ready:
            rest = [r for r in held if r[0] * 1000 > mark]
            self.waiting.clear()
            if rest:
                self.waiting.put(rest)
            self.tail.put(run[-(DEPTH - 1):])
        return iter([lag_row(run, i, self.names, self.cols) for i in range(len(tail), len(run))])


def stream_lags(stream: DataFrame, cols=AVG_FEATURES, delay: str = "2 hours", tz: str = "UTC") -> DataFrame:
    """Lag features of a stream of matched locations (append mode); rows may be ``delay`` late. The keys are TRIP_DAY."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    timed = stream.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", delay)
    # names the event time so that the marker reaches the watermark before it is left out
    real = timed.where(~F.col("trip_id").eqNullSafe(END_TRIP) | F.col("event_time").isNull())
    return real.groupBy(*TRIP_DAY).transformWithState(TripDayLags(cols, tz), output_schema(cols), "append", "EventTime")
