"""File ingestion, streaming and ML operators."""

import json
import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from mercato.sources import files


def test_weather_json_arrays(spark):
    d = tempfile.mkdtemp()
    recs = [{"date": "2024-01-01", "city": "Paris", "region": "IDF", "temp_max_c": 21.5, "temp_min_c": 10,
             "precipitation_mm": 0.0, "wind_kmh": 12.5, "is_sunny": True, "weather_label": "ensoleillé"},
            {"date": "2024-01-01", "city": "Lyon", "region": "ARA", "temp_max_c": "n/a", "temp_min_c": 3,
             "precipitation_mm": 7.5, "wind_kmh": 5, "is_sunny": False, "weather_label": "pluie"}]
    with open(os.path.join(d, "2024-01-01.json"), "w", encoding="utf-8") as f:
        json.dump(recs, f, ensure_ascii=False)
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("not a feed file")
    out = files.read_weather(spark, d)
    rows = out.rows.collect()
    assert len(rows) == 1 and rows[0].city == "Paris" and rows[0].max_temperature_c == 21.5
    assert set(out.rows.columns) == set(files.WEATHER_TYPES)
    assert [r.city for r in out.rejects.collect()] == ["Lyon"]


def test_competitor_csv_header_echo_and_blank_keys(spark):
    d = tempfile.mkdtemp()
    hdr = "snapshot_month,product_id,product_name,category,competitor,competitor_price,our_price,price_gap_pct,is_cheaper,source\n"
    with open(os.path.join(d, "competitor_prices_2024_01.csv"), "w", encoding="utf-8") as f:
        f.write(hdr + "2024-01,1,p1,c,BonPrix,9.0,10.0,-10.0,true,web\n" + hdr + "2024-01,,p2,c,BonPrix,9.0,10.0,-10.0,true,web\n")
    with open(os.path.join(d, "competitor_prices_2024_02.csv"), "w", encoding="utf-8") as f:
        f.write(hdr + "2024-02,2,p2,c,NeoShop,11.0,10.0,10.0,false,web\n")
    out = files.read_competitor(spark, d)
    assert sorted(r.product_id for r in out.rows.collect()) == [1, 2]
    assert out.rejects.count() == 0


def test_promotions_csv_active_flag(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "promo_calendar.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("promo_id,promo_name,start_date,end_date,category,discount_pct,traffic_boost,is_national,budget_eur,communication_type,is_active\n")
        f.write("1,Soldes Hiver,2024-01-10,2024-02-07,toys,30.0,1.4,true,1000,digital,false\n")
        f.write("2,Black Friday,2024-11-28,2024-11-28,toys,25.0,2.8,true,1000,digital,true\n")
    out = files.read_promotions(spark, p, F.lit("2024-01-15").cast("date")).rows.orderBy("promo_id").collect()
    assert [(r.promo_name, r.is_active) for r in out] == [("Winter Sales", True), ("Black Friday", False)]


def test_cdc_replay_is_idempotent(spark, sf_dir):
    from mercato.session import scratch_path
    from mercato.streaming import jobs as S
    import uuid
    target = scratch_path(spark, f"cdc-test-{uuid.uuid4().hex[:8]}")
    S.cdc_apply_stream(S.change_feed(S.event_stream(spark, sf_dir)), target)
    first = S.cdc_current(spark, target)
    expect = S.cdc_state(S.change_feed(spark.read.parquet(f"{sf_dir}/events.parquet")))
    assert first.exceptAll(expect).count() == 0 and expect.exceptAll(first).count() == 0


def test_demand_forecast_shape(spark, sf_dir):
    fc = E.queries()["demand_forecast"](spark, sf_dir)
    ok = fc.where("status = 'ok'")
    per = ok.groupBy("product_id").count().select(F.min("count"), F.max("count")).first()
    if per[0] is not None:
        assert per[0] == per[1] == 90
    assert ok.where("forecast_qty < 0 OR forecast_qty_lower > forecast_qty OR forecast_qty > forecast_qty_upper").count() == 0


def test_kmeans_segments_invariants(spark, sf_dir):
    seg = E.queries()["customer_segments"](spark, sf_dir)
    labels = {r.segment_label for r in seg.select("segment_label").distinct().collect()}
    assert labels == {"Champions", "Loyal", "Warm Prospects", "At Risk", "Inactive"}
    rfm = E.queries()["rfm_features"](spark, sf_dir)
    assert seg.count() == rfm.count()


def test_gold_build_counts_match_queries(spark, sf_dir):
    from mercato.plans.gold import build
    from mercato.session import scratch_path
    out = scratch_path(spark, "gold-test")
    counts = build(spark, sf_dir, out)
    qs = E.queries()
    assert counts["gold_sales_daily"] == qs["sales_daily"](spark, sf_dir).count()
    assert counts["gold_inventory_status"] == qs["inventory_status"](spark, sf_dir).count()
    assert counts["gold_double_risk_products"] == qs["double_risk"](spark, sf_dir).count()
    assert counts["dim_calendar"] == spark.read.parquet(f"{out}/dim_calendar").count()
    assert spark.read.parquet(f"{out}/gold_sales_daily").where("sales_year = 1998").count() > 0


def test_ingest_takes_each_row_once_however_late(spark):
    from mercato.streaming import jobs as S
    d = tempfile.mkdtemp()
    hdr = "snapshot_month,product_id,product_name,category,competitor,competitor_price,our_price,price_gap_pct,is_cheaper,source\n"
    drops = [("2024-12", 1), ("2024-01", 1), ("2024-12", 1), ("2024-01", 2)]  # an old month after a new one, a month again
    for i, (month, n) in enumerate(drops):
        with open(os.path.join(d, f"drop{i}.csv"), "w", encoding="utf-8") as f:
            f.write(hdr + "".join(f"{month},{p},p,c,BonPrix,9.0,10.0,-10.0,true,web\n" for p in range(1, n + 1)))
        os.utime(os.path.join(d, f"drop{i}.csv"), (1000 + i, 1000 + i))
    stream = S.competitor_feed_stream(spark, d, max_files_per_trigger=1)
    got = S.ingest_feed(stream, tempfile.mkdtemp())
    assert sorted((r.snapshot_month, r.product_id) for r in got.toLocalIterator()) == [
        ("2024-01", 1), ("2024-01", 2), ("2024-12", 1)]


def test_late_change_does_not_bring_a_deleted_key_back(spark):
    from mercato.streaming import jobs as S
    d, target = tempfile.mkdtemp(), tempfile.mkdtemp()
    batches = [[(1, "upsert", 1, "first"), (1, "upsert", 2, "other")], [(10, "delete", 1, None)],
               [(5, "upsert", 1, "late"), (7, "upsert", 2, "newer")]]
    schema = "seq long, op string, key long, value string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/b={i}")
    feed = lambda: (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
                    .select("key", "seq", "op", "value"))
    S.cdc_apply_stream(feed(), target)
    want = S.cdc_state(spark.read.schema(schema).parquet(d).select("key", "seq", "op", "value"))
    rows = lambda df: sorted((r.key, r.seq, r.value) for r in df.toLocalIterator())
    assert rows(S.cdc_current(spark, target)) == rows(want) == [(2, 7, "newer")]
    spark.createDataFrame([(11, "upsert", 2, "after restart")], schema).coalesce(1).write.parquet(f"{d}/b=9")
    S.cdc_apply_stream(feed(), target, most_logs=1)
    assert rows(S.cdc_current(spark, target)) == [(2, 11, "after restart")]


def test_competitor_files_with_other_column_order(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as f:
        f.write("snapshot_month,product_id,product_name,competitor_price,our_price\n2024-01,1,\"a, \"\"b\"\"\",9.0,10.0\n")
    with open(os.path.join(d, "b.csv"), "w", encoding="utf-8") as f:
        f.write("our_price,competitor_price,product_id,snapshot_month,extra\n10.0,9.0,2,2024-02,x\n10.0,oops,3,2024-02,x\n")
    out = files.read_competitor(spark, d)
    got = sorted((r.product_id, r.product_name, r.our_price, r.competitor_price) for r in out.rows.toLocalIterator())
    assert got == [(1, 'a, "b"', 10.0, 9.0), (2, None, 10.0, 9.0)]
    assert [r.product_id for r in out.rejects.toLocalIterator()] == ["3"]


def test_truncated_json_is_rejected(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "good.json"), "w") as f:
        json.dump([{"date": "2024-01-01", "city": "Paris"}], f)
    with open(os.path.join(d, "cut.json"), "w") as f:
        f.write('[{"date": "2024-01-02", "city": "Ly')
    out = files.read_weather(spark, d)
    assert [r.city for r in out.rows.toLocalIterator()] == ["Paris"]
    assert out.rejects.count() == 1


def test_totals_count_late_rows(spark):
    from mercato.streaming import jobs as S
    d = tempfile.mkdtemp()
    for i, day in enumerate(("2024-01-05", "2024-01-01")):
        spark.createDataFrame([(i, day, 1, "view", 2.0, "")], "event_id long, ts string, user_id long, event_type string, value double, props string") \
            .withColumn("ts", F.to_timestamp_ntz("ts")).coalesce(1).write.parquet(f"{d}/events-{i}")
    s = spark.readStream.schema(S.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(d)
    got = S.totals_merged(s.withColumn("ts", F.col("ts").cast("timestamp")), tempfile.mkdtemp())
    assert sorted((str(r.window_start.date()), r.n) for r in got.toLocalIterator()) == [("2024-01-01", 1), ("2024-01-05", 1)]


def test_table_audit_reports_missing(spark, sf_dir):
    from mercato.operators.quality import table_audit
    rows = {r.tbl: (r.exists, r.rows) for r in table_audit(spark, ["orders", "no_such_table"], sf_dir).toLocalIterator()}
    assert rows["orders"][0] and rows["orders"][1] > 0
    assert rows["no_such_table"] == (False, None)


def test_pivot_matrix_layout(spark, sf_dir):
    from mercato.plans.reports import pivot_wide
    long = E.queries()["rpt_05_category_region"](spark, sf_dir)
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    wide = pivot_wide(long, ["category"], "region", "avg_coverage_days", regions)
    assert wide.columns == ["category"] + regions
    assert wide.count() == long.select("category").distinct().count()
