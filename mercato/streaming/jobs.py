"""Structured Streaming jobs (STR-01..05).

All jobs read a file source (the event feed or dropped files) and write to
Parquet sinks under the shared checkpoint folder -- nothing is collected on
the driver.  Jobs that emit closed windows take the lateness they wait for
as a parameter without default, since rows later than that are left out;
the ``*_merged`` and ingest jobs keep partial results per batch instead and
leave nothing out.  ``run_available``
drains everything available now and stops (the batch-equivalent run used
by tests and registered queries); production runs use a processing-time
trigger on the same query.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mercato.session import scratch_path
from mercato.sources import folders
from mercato.streaming.changelog import DELETED, ChangeLog

EVENTS_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
                 "value double, props string")


def event_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The event feed as a stream: Parquet files named events*.parquet in
    ``folder``; event time cast from TIMESTAMP_NTZ to TIMESTAMP (session
    zone UTC) because watermarks need the latter."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def run_available(df: DataFrame, sink: str, mode: str = "append", name: str | None = None,
                  partition_by: list[str] | None = None) -> str:
    """Drain a stream into Parquet files under the checkpoint folder (or
    ``sink``) with trigger(availableNow) and wait; returns the sink path."""
    spark = df.sparkSession
    tag = name or uuid.uuid4().hex[:8]
    path = sink or scratch_path(spark, f"stream-{tag}-{uuid.uuid4().hex[:6]}")
    w = (df.writeStream.format("parquet").outputMode(mode).option("path", os.path.join(path, "data"))
         .option("checkpointLocation", os.path.join(path, "_checkpoint")).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q: StreamingQuery = w.start()
    q.awaitTermination()
    return os.path.join(path, "data")


# ---- STR-03: windowed sales totals ---------------------------------------
def windowed_totals(events: DataFrame, watermark: str, window: str = "1 day", slide: str | None = None,
                    by: tuple = ("event_type",)) -> DataFrame:
    """Tumbling (slide None) or sliding window counts and value totals per
    key, with a watermark; late rows (older than the watermark) are dropped
    and only closed windows are emitted in append mode."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (events.withWatermark("ts", watermark).groupBy(w.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total_value"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by, "n", "total_value"))


def by_batch(stream: DataFrame, base: str, transform, partition_by: tuple = ()) -> str:
    """Write ``transform(batch)`` of every micro-batch to its own folder
    batch_id=N, replaced when a batch is retried, so no row counts twice;
    returns the table's path."""
    data = f"{base.rstrip('/')}/data"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        w = transform(batch, batch_id).write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{data}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{base.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return data


def totals_merged(events: DataFrame, base: str, window: str = "1 day", by: tuple = ("event_type",)) -> DataFrame:
    """STR-03 without lateness: each batch leaves its partial totals per
    window, and a window's total is the sum of its partials, however late
    its rows came."""
    cents = F.sum(F.col("value").cast("decimal(12,2)"))

    def partial(batch: DataFrame, _: int) -> DataFrame:
        return (batch.groupBy(F.window("ts", window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), cents.alias("total"))
                .select("w.start", "w.end", *by, "n", "total"))

    path = by_batch(events, base, partial)
    return (events.sparkSession.read.parquet(path).groupBy("start", "end", *by)
            .agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total_value"))
            .select(F.col("start").cast("timestamp_ntz").alias("window_start"),
                    F.col("end").cast("timestamp_ntz").alias("window_end"), *by, "n", "total_value"))


# ---- STR-05: POS silence via session windows ---------------------------------
def pos_sessions(events: DataFrame, n_stores: Column | int, watermark: str, gap: str = "45 minutes") -> DataFrame:
    """Activity sessions per store: a session closes after ``gap`` without a
    purchase; its end is the moment the store has been silent for ``gap``
    (pos_silence alert time)."""
    pos = (events.where(F.col("event_type") == "purchase")
           .withColumn("store_id", F.col("user_id") % n_stores))
    s = F.session_window("ts", gap)
    return (pos.withWatermark("ts", watermark).groupBy("store_id", s.alias("s"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select("store_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("silence_from"), "n_events"))


# ---- STR-04: sales spike, batch comparison per micro-batch --------------------
def spike_alerts_stream(events: DataFrame, n_stores: Column | int, base: str, watermark: str, k: float = 3.0,
                        trailing_days: int = 7) -> str:
    """Daily purchase counts per store (closed windows) are kept per batch;
    each micro-batch then flags the days whose count exceeds k x the mean of
    the days before, reading back only the days its own can look at."""
    from mercato.operators.ops import spikes_from_counts
    counts = windowed_totals(events.where(F.col("event_type") == "purchase")
                             .withColumn("store_id", F.col("user_id") % n_stores), watermark, "1 day", by=("store_id",))
    spark = events.sparkSession
    days_path, alerts_path = f"{base.rstrip('/')}/days", f"{base.rstrip('/')}/alerts"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        day = batch.select("store_id", F.to_date("window_start").alias("day"), "n")
        span = day.agg(F.date_sub(F.min("day"), trailing_days).alias("lo"), F.max("day").alias("hi")).first()
        if span["lo"] is None:  # a batch that only moves the watermark
            return
        day.write.mode("overwrite").partitionBy("day").parquet(f"{days_path}/batch_id={batch_id}")
        hist = spark.read.parquet(days_path).where(F.col("day").between(F.lit(span["lo"]), F.lit(span["hi"])))
        alerts = spikes_from_counts(hist.select("store_id", "day", "n"), k, trailing_days)
        new = alerts.withColumn("d", F.date_sub(F.to_date("created_at"), 1)).join(
            day.select("store_id", F.col("day").alias("d")), ["store_id", "d"], "left_semi").drop("d")
        new.write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")

    none = spikes_from_counts(spark.createDataFrame([], "store_id long, day date, n long"))
    none.write.mode("overwrite").parquet(f"{alerts_path}/batch_id=-1")  # the table exists before its first alert
    q = (counts.writeStream.outputMode("append").foreachBatch(on_batch)
         .option("checkpointLocation", f"{base.rstrip('/')}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return alerts_path


# ---- STR-01: CDC apply -------------------------------------------------------
def change_feed(events: DataFrame) -> DataFrame:
    """Events read as a change feed: key = user_id, seq = event_id, an
    'error' event deletes the key, any other event upserts its payload."""
    return events.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"),
                         F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
                         "event_type", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


def latest_per_key(changes: DataFrame, keys=("key",), seq: str = "seq") -> DataFrame:
    """Latest change per key (by sequence number): max of a struct ordered by
    seq, a partial aggregate (no per-key sort of all changes)."""
    cols = [c for c in changes.columns if c not in keys]
    latest = changes.groupBy(*keys).agg(F.max(F.struct(seq, *[c for c in cols if c != seq])).alias("c"))
    return latest.select(*keys, *[F.col(f"c.{c}").alias(c) for c in [seq] + [c for c in cols if c != seq]])


def cdc_state(changes: DataFrame, keys=("key",), seq: str = "seq") -> DataFrame:
    """Batch CDC semantics: latest change per key wins; deletes drop the key."""
    return latest_per_key(changes, keys, seq).where(F.col("op") != "delete").drop("op")


def _change_log(spark: SparkSession, target: str, schema, **how) -> ChangeLog:
    return ChangeLog(spark, f"{target.rstrip('/')}/table", schema, **how)


def cdc_apply_stream(changes: DataFrame, target: str, keys=("key",), seq: str = "seq", share: float = 0.5,
                     most_logs: int = 32) -> str:
    """STR-01: apply a change stream to a Parquet table with foreachBatch.

    The table is a change log with compaction (``mercato.streaming.changelog``):
    a micro-batch adds the latest change of each of its keys and becomes
    visible by one commit, so a replayed batch changes nothing, a job that
    dies anywhere loses nothing, and a small batch rewrites nothing else.
    Deletes stay as tombstones; ``cdc_current`` leaves them out."""
    spark = changes.sparkSession

    def tombstoned(df: DataFrame) -> DataFrame:
        return df.withColumn(DELETED, F.col("op") == "delete").drop("op")

    schema = tombstoned(changes).schema
    log = _change_log(spark, target, schema, keys=keys, seq=seq, share=share, most_logs=most_logs)
    # the reader finds columns and keys beside the table
    folders.put_text(spark, f"{log.path}/_schema", json.dumps({"schema": schema.json(), "keys": list(keys), "seq": seq}))
    q = (changes.writeStream.foreachBatch(lambda batch, batch_id: log.apply(tombstoned(batch), batch_id))
         .option("checkpointLocation", f"{target.rstrip('/')}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return target


def cdc_current(spark: SparkSession, target: str) -> DataFrame:
    """Current rows of a CDC-applied table."""
    spec = json.loads(folders.get_text(spark, f"{target.rstrip('/')}/table/_schema"))
    schema = StructType.fromJson(json.loads(spec["schema"]))
    return _change_log(spark, target, schema, keys=spec["keys"], seq=spec["seq"]).current()


# ---- STR-06 on a feed: stock alerts from inventory snapshot files ------------
def stock_alert_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Inventory status files arriving in ``folder`` mapped to alert rows as
    they land (a stateless projection: no state, no shuffle)."""
    from mercato.operators.ops import stock_alerts
    inv = spark.readStream.schema(schema).parquet(folder)
    return stock_alerts(inv)


# ---- STR-02: competitor feed ingested incrementally ------------------------------
COMPETITOR_KEYS = ("snapshot_month", "product_id", "competitor")


def competitor_feed_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Monthly competitor CSV drops read as a stream: header echoes and blank
    keys dropped, typed."""
    from mercato.sources.files import COMPETITOR_TYPES
    raw = ", ".join(f"{c} string" for c in COMPETITOR_TYPES)
    # enforceSchema off: each file's header is checked against the layout
    reader = (spark.readStream.schema(raw).option("header", True).option("enforceSchema", False)
              .option("pathGlobFilter", "*.csv"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    key = F.trim(F.col("product_id"))
    df = reader.csv(folder)
    clean = df.where(key.isNotNull() & (key != "") & (key != "product_id"))
    return clean.select(*[F.trim(F.col(c)).try_cast(t).alias(c) if t != "string" else F.col(c)
                          for c, t in COMPETITOR_TYPES.items()])


def ingest_feed(stream: DataFrame, base: str, keys=COMPETITOR_KEYS, partition_col: str = "snapshot_month") -> DataFrame:
    """Append a feed, a row of known keys only once, however late it is
    delivered again: a batch is compared with the partitions it touches of
    what earlier batches wrote.  Returns the table."""
    spark = stream.sparkSession
    data = f"{base.rstrip('/')}/data"
    shape = stream.schema
    empty = spark.createDataFrame([], shape).withColumn("batch_id", F.lit(-1))

    def new_rows(batch: DataFrame, batch_id: int) -> DataFrame:
        batch = batch.dropDuplicates(list(keys))
        if batch_id == 0:
            return batch
        done = spark.read.schema(empty.schema).parquet(data).where(F.col("batch_id") < batch_id)
        touched = batch.select(partition_col).distinct()
        done = done.join(touched, partition_col, "left_semi").select(*keys)
        return batch.join(done, list(keys), "left_anti")

    by_batch(stream, base, new_rows, (partition_col,))
    return spark.read.schema(empty.schema).parquet(data).select(*shape.names)
