"""STR-05: stitched sessions, alarms by timer."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mercato.streaming import jobs as S
from mercato.streaming import silence as Z

T0 = dt.datetime(2024, 1, 1, 8, 0)


def _events(spark, rows):
    """(minutes after eight, user, type)"""
    return spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m), u, k, 1.0, "") for i, (m, u, k) in enumerate(rows)], S.EVENTS_SCHEMA)


def _minutes(ts):
    return (ts - T0).total_seconds() / 60


def test_equal_to_the_session_window(spark):
    r = random.Random(2)
    rows = [(r.choice([0, 44.99, 45, 45.01, 90]) + r.randrange(0, 9000, 15) + r.random() * r.choice([0, 1]), r.randrange(5), "purchase") for _ in range(1500)]
    sales = Z.store_sales(_events(spark, rows), 3)
    got = Z.sessions(sales)
    w = sales.groupBy("store_id", F.session_window(F.col("ts").cast("timestamp"), "45 minutes").alias("s")).agg(F.count(F.lit(1)).alias("n_sales"))
    want = w.select("store_id", F.col("s.start").cast("timestamp_ntz"), (F.col("s.end") - F.expr("INTERVAL 45 MINUTES")).cast("timestamp_ntz"), "n_sales")
    assert got.count() > 20 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_hot_store_is_summed_before_it_moves(spark, tmp_path):
    day = spark.range(200_000, numPartitions=8).select(F.lit(7).alias("store_id"), F.timestamp_micros(F.col("id") * 432_000).alias("ts"))
    day.write.parquet(str(tmp_path / "d"))
    df = Z.sessions(spark.read.parquet(str(tmp_path / "d")))
    assert [r.n_sales for r in df.collect()] == [200_000]
    # below the first exchange stands a partial sum; the window above it sees 32 slices of the day
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "partial_min(at" in plan.split("Window")[-1]
    assert spark.read.parquet(str(tmp_path / "d")).select(F.floor(F.unix_micros("ts") / (45 * 60_000_000))).distinct().count() == 32


def _alarms(spark, tmp_path, files, watermark="0 seconds"):
    feed = tmp_path / "feed"
    for i, rows in enumerate(files):
        _events(spark, rows).coalesce(1).write.parquet(str(feed / f"events-{i}"))
    stream = (spark.readStream.schema(S.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
              .parquet(str(feed)).withColumn("ts", F.col("ts").cast("timestamp")))
    path = Z.with_rocksdb(spark, lambda: S.run_available(Z.silence_alarms(stream, 10, watermark), str(tmp_path / "out")))
    return sorted((r.store_id, _minutes(r.session_start), _minutes(r.last_sale), _minutes(r.alarm_at), r.n_sales)
                  for r in spark.read.parquet(path).collect())


def test_a_feed_that_stops_raises_one_alarm_per_store(spark, tmp_path):
    # both stores sell, then neither does again; only clicks move the clock
    files = [[(0, 1, "purchase"), (10, 1, "purchase"), (20, 2, "purchase")], [(30, 1, "purchase"), (31, 9, "click")],
             [(100, 9, "click")], [(400, 9, "click")], [(800, 9, "click")]]
    assert _alarms(spark, tmp_path, files) == [(1, 0, 30, 75, 3), (2, 20, 20, 65, 1)]


def test_a_store_that_sells_again_alarms_again_and_a_busy_one_never(spark, tmp_path):
    busy = [[(m, 3, "purchase") for m in range(60 * k, 60 * k + 60, 20)] for k in range(6)]
    busy[0] += [(5, 4, "purchase")]
    busy[3] += [(200, 4, "purchase"), (244.9, 4, "purchase")]
    assert _alarms(spark, tmp_path, busy) == [(4, 5, 5, 50, 1), (4, 200, 244.9, 289.9, 2)]


def test_late_sales_within_the_watermark_prevent_an_alarm(spark, tmp_path):
    files = [[(0, 1, "purchase"), (80, 9, "click")], [(40, 1, "purchase"), (90, 9, "click")], [(300, 9, "click")], [(301, 9, "click")]]
    assert _alarms(spark, tmp_path, files, "1 hour") == [(1, 0, 40, 85, 2)]


@pytest.mark.parametrize("rows", [[], [(0, 1, "click")]])
def test_no_sales(spark, rows):
    assert Z.sessions(Z.store_sales(_events(spark, rows), 3)).count() == 0
