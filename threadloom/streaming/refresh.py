"""A cache of items that follows a stream of changes: bursts are debounced, deletes take items out, state lives in timers and values.

The processor keeps the changes of a key that may still belong to an open burst, and a timer for each change that may end one. When the watermark has passed
`gap` after a burst's last change, no earlier change can come: the burst's last value becomes the item, or takes it out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers need; other queries keep the session's setting."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


class _Refresh(StatefulProcessor):
    def __init__(self, gap_ms: int):
        self.gap = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, seq long, gone boolean, value string")
        self.item = handle.getValueState("item", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for part in rows:
            new += [(int(at), int(seq), bool(gone), None if gone else value) for at, seq, gone, value in zip(part["at"], part["seq"], part["gone"], part["value"], strict=True)]
        if new:
            self.waiting.appendList(new)
        # A timer for each change that may end a burst; changes that come later can only make fewer of them ends.
        times = sorted(x[0] for x in new)
        for at, after in zip(times, [*times[1:], None], strict=True):
            if after is None or after - at >= self.gap:
                self.handle.registerTimer(at + self.gap)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out = timerValues.getCurrentWatermarkInMs(), []
        rows = sorted(self.waiting.get())
        bursts: list[list[tuple]] = []
        for r in rows:
            if not bursts or r[0] - bursts[-1][-1][0] >= self.gap:
                bursts.append([])
            bursts[-1].append(r)
        open_rows = [r for b in bursts if b[-1][0] + self.gap > now for r in b]
        for b in bursts:
            at, _, gone, value = b[-1]
            if at + self.gap > now:
                continue
            if not gone:
                self.item.update((value,))
            elif self.item.exists():
                self.item.clear()
            else:
                continue
            out.append((*key, "delete" if gone else "put", None if gone else value, len(b), at))
        self.waiting.clear()
        if open_rows:
            self.waiting.put(open_rows)
        if out:
            yield pd.DataFrame(out, columns=["key", "op", "value", "changes", "at"])

    def close(self) -> None:
        pass


def refreshes(changes: DataFrame, gap: str = "2 seconds", late: str = "10 minutes") -> DataFrame:
    """(key, op, value, changes, at) for each burst of the stream changes(key string, ts, seq, gone, value): op put or delete, the value after
    the burst, its number of changes, the time of the last one in milliseconds. Ties of ts go by seq. A delete of what is not there gives no
    row. Bursts appear once the watermark, `late` behind the newest change, has passed their end. Start it inside keyed_state()."""
    ms = int(pd.Timedelta(gap).total_seconds() * 1000)
    rows = changes.withWatermark("ts", late).select("key", "ts", F.unix_millis("ts").alias("at"), "seq", F.coalesce("gone", F.lit(False)).alias("gone"), "value")
    return rows.groupBy("key").transformWithStateInPandas(_Refresh(ms), "key string, op string, value string, changes long, at long", "Append", "EventTime")


def bursts(changes: DataFrame, gap: str = "2 seconds", until_ms: int | None = None) -> DataFrame:
    """The batch form: (key, op, value, changes, at) of all bursts that end before until_ms, deletes of what is not there included."""
    ms = int(pd.Timedelta(gap).total_seconds() * 1000)
    order = Window.partitionBy("key").orderBy("at", "seq")
    rows = changes.select("key", F.unix_millis("ts").alias("at"), "seq", F.coalesce("gone", F.lit(False)).alias("gone"), "value")
    fresh = F.coalesce(F.col("at") - F.lag("at").over(order) >= ms, F.lit(True)).cast("int")
    numbered = rows.withColumn("fresh", fresh).withColumn("burst", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max(F.struct("at", "seq", "gone", "value"))
    found = numbered.groupBy("key", "burst").agg(last.alias("x"), F.count(F.lit(1)).alias("changes"))
    found = found.select("key", F.when(F.col("x.gone"), "delete").otherwise("put").alias("op"), F.when(~F.col("x.gone"), F.col("x.value")).alias("value"), "changes", F.col("x.at").alias("at"))
    return found if until_ms is None else found.filter(F.col("at") + ms <= until_ms)


def items(refreshed: DataFrame) -> DataFrame:
    """(key, value, changes, at) of the keys that are there after all refreshes: the last one of each key, if it is no delete."""
    last = refreshed.groupBy("key").agg(F.max(F.struct("at", "op", "value", "changes")).alias("x"))
    return last.filter("x.op = 'put'").select("key", "x.value", "x.changes", "x.at")
