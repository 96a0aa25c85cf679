"""Customer RFM features (AGG-12), winsorising (ML-01), segmentation (ML-02..05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import SEGMENT_LABELS
from mercato.operators import kmeans
from mercato.sources.retail import Retail

# The clustering features.
FEATURES = ["recency_days", "frequency", "monetary", "avg_basket", "nb_distinct_products"]

# Score cut points of the rule-based segment labels (score as in AGG-15:
# -R/maxR + F/maxF + M/maxM).  Fixed parameters of this engine.
SCORE_CUTS = (1.0, 0.7, 0.45, 0.2)


def rfm_features(r: Retail, reference_date: Column | None = None) -> DataFrame:
    """AGG-12: per customer last order, frequency, monetary, mean line, products.

    ``avg_basket`` is the mean *line* total (kept as named in the source)."""
    ref = reference_date if reference_date is not None else r.as_of
    # the products are reduced per customer first, so neither distinct count expands the lines
    products = (r.order_lines.select("customer_id", "product_id").distinct().groupBy("customer_id")
                .agg(F.count(F.lit(1)).alias("nb_distinct_products")))
    per_order = (r.order_lines.groupBy("customer_id", "order_id")
                 .agg(F.max("order_date").alias("order_date"), F.sum("line_total").alias("total"),
                      F.count(F.lit(1)).alias("lines")))
    g = (per_order.groupBy("customer_id")
         .agg(F.max("order_date").alias("last_order_date"), F.count(F.lit(1)).alias("frequency"),
              F.sum("total").alias("monetary_dec"), F.sum("lines").alias("n_lines"))
         .join(products, "customer_id"))
    return g.select("customer_id", "last_order_date",
                    F.datediff(ref, "last_order_date").alias("recency_days"), "frequency",
                    F.col("monetary_dec").cast("double").alias("monetary"),
                    (F.col("monetary_dec").cast("double") / F.col("n_lines")).alias("avg_basket"),
                    "nb_distinct_products")


def winsorise(rfm: DataFrame, q: float = 0.99, features=FEATURES) -> DataFrame:
    """ML-01: NULL -> 0, then clip each feature at its q-quantile (linear
    interpolation, as pandas).  Each cap is an exact quantile computed with
    bounded memory (``mercato.functions.quantile``)."""
    from mercato.functions.quantile import exact_quantiles
    filled = rfm.select("customer_id", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f)
                                         for f in features])
    # the caps read the features several times: materialise them once in the
    # shared checkpoint folder (cuts the lineage back to the order lines)
    filled = filled.checkpoint(eager=True)
    caps = exact_quantiles(filled, list(features), q)
    return filled.select("customer_id", *[F.least(F.col(f), F.lit(caps[f]).cast("double")).alias(f)
                                          for f in features])


def score(rec: Column, freq: Column, mon: Column, max_rec: Column, max_freq: Column,
          max_mon: Column) -> Column:
    """AGG-15 score: low recency, high frequency and spend rank first."""
    return -rec / max_rec + freq / max_freq + mon / max_mon


def rule_segments(r: Retail) -> DataFrame:
    """Segment table labelled by score cut points (SQL-checkable stand-in
    for the K-Means labels, same schema as customer_segments)."""
    # one customer-level table read twice (maxima, then labels): materialise
    # it once in the shared checkpoint folder
    rfm = rfm_features(r).checkpoint(eager=True)
    mx = rfm.agg(F.max("recency_days").alias("r"), F.max("frequency").alias("f"),
                 F.max("monetary").alias("m")).first()
    s = score(F.col("recency_days").cast("double"), F.col("frequency").cast("double"), F.col("monetary"),
              F.lit(float(mx["r"])), F.lit(float(mx["f"])), F.lit(float(mx["m"])))
    sc = F.col("score")
    seg_id = (F.when(sc >= SCORE_CUTS[0], 0).when(sc >= SCORE_CUTS[1], 1).when(sc >= SCORE_CUTS[2], 2)
              .when(sc >= SCORE_CUTS[3], 3).otherwise(4))
    labels = F.array(*[F.lit(x) for x in SEGMENT_LABELS])
    return (rfm.withColumn("score", s).withColumn("segment_id", seg_id).drop("score")
            .withColumn("segment_label", F.element_at(labels, F.col("segment_id") + 1)))


def fitted_segments(r: Retail, k: int = 5, seed: int = 42, restarts: int = 10, clip: float = 0.99,
                    max_iter: int = 300) -> tuple[DataFrame, kmeans.Model]:
    """ML-02, ML-03: the winsorised customers (``customer_id`` and features)
    with their RFM row (``rfm``) and segment number, and the fitted model:
    the best of ``restarts`` K-Means fits, all advanced by one job per iteration."""
    # one customer table, materialised in the shared checkpoint folder: the
    # iterations read features, the labels read the RFM columns
    rfm = rfm_features(r).checkpoint(eager=True)
    w = winsorise(rfm, clip).checkpoint(eager=True)
    model = kmeans.fit(w, "customer_id", FEATURES, k, seed, restarts, max_iter)
    return kmeans.assign(w, model, FEATURES).join(rfm.select("customer_id", F.struct(*rfm.columns).alias("rfm")), "customer_id"), model


def kmeans_segments(r: Retail, k: int = 5, **how) -> DataFrame:
    """ML-02..05: segments of ``fitted_segments``, labelled by score rank."""
    fitted, _ = fitted_segments(r, k, **how)
    return label_by_score(fitted.select("rfm.*", "segment_id"), k)


def fixed_point(fitted: DataFrame, model: kmeans.Model, features=FEATURES) -> DataFrame:
    """ML-03 checked on the result: per segment its customers, how many of them
    have a nearer centre, and how far the centre is from their mean (in
    standard units, the largest feature)."""
    x = kmeans.distances(fitted, model, list(features))
    own = F.element_at("distance", F.col("segment_id") + 1)
    unit = lambda f: (F.col(f) - F.lit(model.mean[f])) / F.lit(model.std[f])
    centre = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.centres])
    g = x.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n_customers"), F.count_if(own > F.array_min("distance")).alias("n_nearer_elsewhere"),
                                    *[F.avg(unit(f)).alias(f) for f in features])
    off = F.greatest(*[F.abs(F.col(f) - centre[F.col("segment_id")][i]) for i, f in enumerate(features)])
    return g.select("segment_id", "n_customers", "n_nearer_elsewhere", off.alias("centre_off"))


def assert_all_labels(seg: DataFrame, labels=SEGMENT_LABELS) -> DataFrame:
    """ML-04: ``seg`` itself, after checking that every label occurs."""
    found = {r[0] for r in seg.select("segment_label").distinct().limit(len(labels) + 1).toLocalIterator()}
    if found != set(labels):
        raise ValueError(f"segment labels {sorted(found)} instead of {sorted(labels)}")
    return seg


def label_by_score(seg: DataFrame, k: int = 5) -> DataFrame:
    """AGG-15 + ML-04: profile means per segment, score, rank (tie-break on
    segment_id), label; the k profile rows are joined back (broadcast, k rows)."""
    from pyspark.sql import Window
    if k > len(SEGMENT_LABELS):
        raise ValueError(f"{k} segments, but only {len(SEGMENT_LABELS)} labels")
    prof = seg.groupBy("segment_id").agg(*[F.avg(f).alias(f) for f in ("recency_days", "frequency", "monetary")])
    w_all = Window.partitionBy()
    s = score(F.col("recency_days"), F.col("frequency"), F.col("monetary"),
              F.max("recency_days").over(w_all), F.max("frequency").over(w_all),
              F.max("monetary").over(w_all))
    ranked = prof.select("segment_id", s.alias("score")).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc("score"), "segment_id")))
    labels = F.array(*[F.lit(x) for x in SEGMENT_LABELS])
    lab = ranked.select("segment_id", F.element_at(labels, F.col("rank"))
                        .alias("segment_label"))
    return seg.join(F.broadcast(lab), "segment_id").select(
        "customer_id", "last_order_date", "recency_days", "frequency", "monetary", "avg_basket",
        "nb_distinct_products", F.col("segment_id").cast("int").alias("segment_id"), "segment_label")


def segment_counts(seg: DataFrame) -> DataFrame:
    """AGG-16: customers per segment."""
    return seg.groupBy("segment_label").agg(F.count(F.lit(1)).alias("count"))
