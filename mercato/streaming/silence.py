"""POS silence (STR-05): sessions of sales per store, and alarms by timer.

Sales are first reduced per (store, time slice), a slice being no longer
than the silence that ends a session: any two sales of a slice belong together,
so a slice is one row, made by partial aggregation however many sales a
store has.  Neighbouring slices are then stitched: a slice goes on with the
session before it when its first sale comes within the gap of the last one.
What meets per store is one row per slice of its calendar, not its sales.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

GAP_MINUTES = 45
SLICE_MINUTES = 5  # of the stream: an alarm is late by less than this
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def store_sales(events: DataFrame, n_stores: Column | int) -> DataFrame:
    """Purchases of the feed with their store."""
    return events.where(F.col("event_type") == "purchase").withColumn("store_id", F.col("user_id") % n_stores)


def sessions(sales: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """(store_id, first_ts, last_ts, n_sales): runs of sales no more than the gap apart."""
    gap = gap_minutes * 60_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    slices = (sales.select("store_id", at.alias("at")).groupBy("store_id", F.floor(F.col("at") / gap).alias("slice"))
              .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n")))
    by_slice = Window.partitionBy("store_id").orderBy("slice")
    starts = F.coalesce(F.col("first") - F.lag("last").over(by_slice) > gap, F.lit(True))
    upto = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = slices.withColumn("starts", starts).withColumn("run", F.count_if("starts").over(upto))
    time = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return run.groupBy("store_id", "run").agg(F.min("first").alias("f"), F.max("last").alias("l"), F.sum("n").alias("n_sales")).select(
        "store_id", time("f").alias("first_ts"), time("l").alias("last_ts"), "n_sales")


class SilenceAlarm(StatefulProcessor):
    """Per store the open session; a timer at the end of the slice that holds its
    last sale plus the gap raises the alarm."""

    def __init__(self, gap_minutes: int, slice_minutes: int) -> None:
        self.gap, self.slice = gap_minutes * 60_000_000, slice_minutes * 60_000_000  # microseconds, as all times here

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first long, last long, n long")

    def _alarm(self, store: int, first: int, last: int, n: int) -> dict:
        time = lambda at: pd.Timestamp(at, unit="us")
        return {"store_id": store, "session_start": time(first), "last_sale": time(last), "alarm_at": time(last + self.gap), "n_sales": n}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        slices = sorted((int(f), int(l), int(n)) for b in rows for f, l, n in zip(b["first"], b["last"], b["n"]))
        first, last, n = self.open.get() if self.open.exists() else (None, None, 0)
        out = []
        for f, l, m in slices:
            if last is not None and f - last > self.gap:
                out.append(self._alarm(key[0], first, last, n))
                first, n = None, 0
            first, last, n = f if first is None else first, l if last is None else max(last, l), n + m
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.open.update((first, last, n))
        # a sale up to the end of the gap is known when its slice is closed; timers are set in milliseconds
        self.handle.registerTimer(((last + self.gap) // self.slice + 1) * self.slice // 1000)
        yield pd.DataFrame(out, columns=["store_id", "session_start", "last_sale", "alarm_at", "n_sales"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            first, last, n = self.open.get()
            self.open.clear()
            yield pd.DataFrame([self._alarm(key[0], first, last, n)])

    def close(self) -> None:
        pass


def silence_alarms(events: DataFrame, n_stores: Column | int, watermark: str, gap_minutes: int = GAP_MINUTES,
                   slice_minutes: int = SLICE_MINUTES) -> DataFrame:
    """One alarm per silence of a store, raised when the clock passes its last
    sale by the gap (to the next full slice), whether or not it ever sells again.

    The clock is the watermark over all events of the feed, so that of a
    store whose sales stop is moved by anything else that is recorded.  Run
    it with the RocksDB state store (``with_rocksdb``)."""
    # no filter on the kind of event before the aggregation: it would sink below the watermark, and only sales would move the clock
    sale = F.col("event_type") == "purchase"
    at = F.when(sale, F.unix_micros("ts"))
    slices = (events.withWatermark("ts", watermark).withColumn("store_id", F.col("user_id") % n_stores)
              .groupBy("store_id", F.window("ts", f"{slice_minutes} minutes").alias("w"))
              .agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count_if(sale).alias("n")).where("n > 0")
              .select("store_id", F.window_time("w").alias("slice_time"), "first", "last", "n"))
    return slices.groupBy("store_id").transformWithStateInPandas(
        SilenceAlarm(gap_minutes, slice_minutes), "store_id long, session_start timestamp, last_sale timestamp, alarm_at timestamp, n_sales long",
        "append", "eventTime")


def with_rocksdb(spark, run):
    """``run()`` under the state store that timers need; the setting is put back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        return run()
    finally:
        spark.conf.set(name, before)
