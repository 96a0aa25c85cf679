"""Demand forecasting: daily actuals (AGG-06), top SKUs (AGG-13), the
SQL-checkable baseline (ML-07), forecast vs actual (AGG-07) and the
per-SKU seasonal model (ML-06, grouped-map pandas on executors)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.dax import davg, div, dsum
from mercato.sources.retail import Retail, dec

FORECAST_COLS = ["product_id", "forecast_date", "forecast_qty", "forecast_qty_lower", "forecast_qty_upper"]


def daily_actuals(r: Retail) -> DataFrame:
    """AGG-06: units sold per product and day."""
    return r.order_lines.groupBy("product_id", "order_date").agg(F.sum("quantity").alias("actual_qty"))


def top_skus(r: Retail, n: int = 200) -> DataFrame:
    """AGG-13: the n best-selling products by volume (ties by product_id).
    The limit is the feature (TakeOrderedAndProject, no global sort)."""
    return (r.order_items.groupBy("product_id").agg(F.sum("quantity").alias("total_qty"))
            .orderBy(F.desc("total_qty"), "product_id").limit(n))


def cutoff_of(r: Retail, horizon: int = 90) -> Column:
    """Training cutoff: the last `horizon` days of history are held out."""
    return F.date_sub(r.as_of, horizon)


def forecast_baseline(r: Retail, horizon: int = 90) -> DataFrame:
    """ML-07: for each product sold in the 8 weeks up to the cutoff, the mean
    units per weekday over those weeks, for every day of the horizon; an
    80-120 % band.  Decimal arithmetic until the final rounding."""
    cutoff = cutoff_of(r, horizon)
    lines = r.order_lines.where((F.col("order_date") > F.date_sub(cutoff, 56))
                                & (F.col("order_date") <= cutoff))
    # the sums of the seven weekdays in one row: the lines are read and shuffled once, the days are not joined
    sums = lines.groupBy("product_id").agg(
        *[F.sum(F.when(F.dayofweek("order_date") == d, F.col("quantity"))).alias(f"qty_{d}") for d in range(1, 8)])
    week = F.array(*[F.struct(F.round(x, 2).cast("double").alias("qty"),
                              F.round(x * dec("0.8", 2, 1), 2).cast("double").alias("lower"),
                              F.round(x * dec("1.2", 2, 1), 2).cast("double").alias("upper"))
                     for x in (F.coalesce(F.col(f"qty_{d}"), F.lit(0)).cast("decimal(18,0)") * dec("0.125", 4, 3) for d in range(1, 8))])
    # a select of its own, so that the week is worked out before its product has a row per day
    days = sums.select("product_id", week.alias("week")).select(
        "product_id", "week", F.explode(F.sequence(F.date_add(cutoff, 1), F.date_add(cutoff, horizon))).alias("forecast_date"))
    of = F.element_at("week", F.dayofweek("forecast_date"))
    return days.select("product_id", "forecast_date", of["qty"].alias("forecast_qty"), of["lower"].alias("forecast_qty_lower"),
                       of["upper"].alias("forecast_qty_upper"))


def forecast_vs_actual(r: Retail, forecast: DataFrame) -> DataFrame:
    """AGG-07: forecast rows with the actual units of that day (0 if none),
    error and accuracy relative to the forecast (NULL at a zero forecast)."""
    products = r.products.select("product_id", F.col("name").alias("product_name"), "category")
    fc = forecast.join(products, "product_id")
    x = fc.join(daily_actuals(r).withColumnRenamed("order_date", "forecast_date"),
                ["product_id", "forecast_date"], "left")
    a = F.coalesce(F.col("actual_qty"), F.lit(0))
    fq = F.col("forecast_qty").cast("decimal(12,2)")
    err = F.abs(fq - a) / fq
    return x.select("product_id", "product_name", "category", "forecast_date",
                    a.alias("actual_qty"), "forecast_qty", "forecast_qty_lower", "forecast_qty_upper",
                    F.when(fq == 0, None).otherwise(F.round(err, 4)).cast("double").alias("forecast_error_pct"),
                    F.when(fq == 0, None).otherwise(F.round(1 - err, 4)).cast("double").alias("forecast_accuracy"))


# ---- ML-06: per-SKU seasonal model with a sparse trend -------------------
# Prior scales, changepoints and interval of the source's model.
CHANGEPOINT_SCALE, SEASON_SCALE, SLOPE_SCALE = 0.05, 10.0, 5.0
N_CHANGEPOINTS, HISTORY_SHARE = 25, 0.8
INTERVAL = 0.8
SAMPLES = 500  # simulated futures of an interval


def _design(t: np.ndarray, changepoints: np.ndarray, n_days: float) -> np.ndarray:
    """Level (first), slope, one hinge per changepoint, then weekly and yearly Fourier terms."""
    cols = [np.ones_like(t), t / n_days]
    cols += [np.maximum(0.0, t - c) / n_days for c in changepoints]
    for period, order in ((7.0, 3), (365.25, 10)):
        for k in range(1, order + 1):
            a = 2 * np.pi * k * t / period
            cols += [np.sin(a), np.cos(a)]
    return np.column_stack(cols)


def sparse_fit(x: np.ndarray, y: np.ndarray, l1: np.ndarray, l2: np.ndarray, rounds: int = 5, sweeps: int = 200,
               tol: float = 1e-5) -> tuple[np.ndarray, float]:
    """Posterior mode under Laplace (``l1``) and normal (``l2``) priors, and the noise.

    Cyclic coordinate descent on the normal equations, alternating with the
    noise variance; a coefficient whose pull stays below its Laplace
    penalty is exactly zero."""
    gram, xy = x.T @ x, x.T @ y
    # from the level alone: what the data don't ask for stays zero
    beta = np.zeros(x.shape[1])
    beta[0] = y.mean()
    var = max(float(np.mean((y - x @ beta) ** 2)), 1e-8)
    for _ in range(rounds):
        den, cut = np.diag(gram) + var * l2 + 1e-12, var * l1
        rest = xy - gram @ beta
        for _ in range(sweeps):
            moved = 0.0
            for j in range(len(beta)):
                pull = rest[j] + gram[j, j] * beta[j]
                new = (np.sign(pull) * max(abs(pull) - cut[j], 0.0)) / den[j] if cut[j] else pull / den[j]
                step = new - beta[j]
                if step:
                    rest -= gram[:, j] * step
                    beta[j] = new
                    moved = max(moved, abs(step))
            if moved < tol:
                break
        before, var = var, max(float(np.mean((y - x @ beta) ** 2)), 1e-8)
        if abs(var - before) < 1e-4 * before:
            break
    return beta, float(np.sqrt(var))


def trend_changes(rng: np.random.Generator, hinges: np.ndarray, n_days: float, horizon: int, samples: int) -> np.ndarray:
    """(samples, horizon): what the trend may gain or lose beyond the history.

    Slopes change as often as the history had changepoints, by Laplace
    steps of the size that its hinges have on average."""
    size = float(np.mean(np.abs(hinges))) if len(hinges) else 0.0
    happens = rng.random((samples, horizon)) < len(hinges) / n_days
    steps = np.where(happens, rng.laplace(0.0, size + 1e-12, (samples, horizon)), 0.0)
    slope = np.cumsum(steps, axis=1)
    return np.cumsum(np.hstack([np.zeros((samples, 1)), slope[:, :-1]]), axis=1) / n_days


def fit_predict(pdf: pd.DataFrame, horizon: int, min_points: int, n_changepoints: int = N_CHANGEPOINTS,
                interval: float = INTERVAL, samples: int = SAMPLES, last=None, zero_days: bool = True) -> pd.DataFrame:
    """One SKU's forecast for the ``horizon`` days after its history.

    ``min_points`` counts selling days; with ``zero_days`` the days without a
    sale from the first sale to ``last`` (else the last sale) count as zero,
    as they do in the comparison with actual units.  The interval holds the
    central share of simulated futures: trend changes plus noise, drawn with
    the product id as seed, so a retried task gives the same rows."""
    pid = pdf["product_id"].iloc[0]
    out_cols = FORECAST_COLS + ["status"]
    if len(pdf) < min_points:
        return pd.DataFrame([[pid, None, None, None, None, f"skipped: {len(pdf)} points"]], columns=out_cols)
    try:
        ds = pd.to_datetime(pdf["order_date"]).values.astype("datetime64[D]")
        y = pdf["y"].astype(float).clip(lower=0).values
        t0, end = ds.min(), np.datetime64(last, "D") if last is not None else ds.max()
        t = (ds - t0).astype(int)
        n_days = float(max((end - t0).astype(int), 1))
        if zero_days:
            y, t = np.bincount(t, weights=y, minlength=int(n_days) + 1), np.arange(int(n_days) + 1)
        scale = max(float(y.max()), 1e-9)
        cps = np.linspace(0, HISTORY_SHARE * n_days, n_changepoints + 1)[1:]
        x = _design(t.astype(float), cps, n_days)
        hinge, season = slice(2, 2 + n_changepoints), slice(2 + n_changepoints, x.shape[1])
        l1, l2 = np.zeros(x.shape[1]), np.full(x.shape[1], 1 / SLOPE_SCALE ** 2)
        l1[hinge], l2[hinge], l2[season] = 1 / CHANGEPOINT_SCALE, 0.0, 1 / SEASON_SCALE ** 2
        beta, sigma = sparse_fit(x, y / scale, l1, l2)
        fut = end + np.arange(1, horizon + 1).astype("timedelta64[D]")
        yhat = _design((fut - t0).astype(float), cps, n_days) @ beta
        rng = np.random.default_rng(abs(int(pid)))
        paths = yhat + trend_changes(rng, beta[hinge], n_days, horizon, samples) + rng.normal(0.0, sigma, (samples, horizon))
        lower, upper = np.quantile(paths, [(1 - interval) / 2, (1 + interval) / 2], axis=0)
        units = lambda v: np.round(np.clip(v * scale, 0, None), 2)
        res = pd.DataFrame({
            "product_id": pid, "forecast_date": fut.astype("datetime64[ns]"), "forecast_qty": units(yhat),
            "forecast_qty_lower": units(np.minimum(lower, yhat)), "forecast_qty_upper": units(np.maximum(upper, yhat)), "status": "ok"})
        res["forecast_date"] = res["forecast_date"].dt.date
        return res[out_cols]
    except Exception as e:  # a failed SKU is reported, not fatal
        return pd.DataFrame([[pid, None, None, None, None, f"error: {e}"]], columns=out_cols)


def demand_forecast(r: Retail, horizon: int = 90, top_n: int | None = 200, min_points: int = 30,
                    cutoff: Column | None = None, zero_days: bool = True) -> DataFrame:
    """ML-06: one model per SKU via applyInPandas; each group is one SKU's
    daily series (bounded by the calendar, not by the data volume)."""
    act = daily_actuals(r).withColumnRenamed("actual_qty", "y")
    if cutoff is not None:
        act = act.where(F.col("order_date") <= cutoff)
    # the history ends on the same day for every SKU
    act = act.withColumn("last", cutoff if cutoff is not None else r.as_of)
    if top_n is not None:
        top = (act.groupBy("product_id").agg(F.sum("y").alias("vol"))
               .orderBy(F.desc("vol"), "product_id").limit(top_n).select("product_id"))
        act = act.join(F.broadcast(top) if top_n <= 100_000 else top, "product_id")
    schema = ("product_id long, forecast_date date, forecast_qty double, forecast_qty_lower double, "
              "forecast_qty_upper double, status string")
    return act.groupBy("product_id").applyInPandas(
        lambda pdf: fit_predict(pdf, horizon, min_points, last=pdf["last"].iloc[0], zero_days=zero_days), schema)


def scores(fva: DataFrame, by=()) -> DataFrame:
    """Held-out quality of a forecast: mean absolute error, error relative to
    the actual units, and the share of days inside the interval."""
    err = F.abs(F.col("actual_qty") - F.col("forecast_qty"))
    aggs = [F.count(F.lit(1)).alias("n_days"), davg(err).alias("mae"), div(dsum(err), F.sum("actual_qty")).alias("relative_error"),
            F.avg(F.col("actual_qty").between(F.col("forecast_qty_lower"), F.col("forecast_qty_upper")).cast("int")).alias("coverage")]
    return fva.groupBy(*by).agg(*aggs) if by else fva.agg(*aggs)


def both_models(r: Retail, horizon: int = 90) -> DataFrame:
    """Forecasts of ML-06 and ML-07 with the actual units, for the products and days that both forecast."""
    model = demand_forecast(r, horizon, cutoff=cutoff_of(r, horizon)).where("status = 'ok'").drop("status").checkpoint(eager=True)
    base = forecast_baseline(r, horizon).join(model.select("product_id", "forecast_date"), ["product_id", "forecast_date"], "left_semi")
    model = model.join(base.select("product_id").distinct(), "product_id", "left_semi")
    every = model.withColumn("model", F.lit("ML-06")).unionByName(base.withColumn("model", F.lit("ML-07")))
    act = daily_actuals(r).withColumnRenamed("order_date", "forecast_date")
    return (every.join(act, ["product_id", "forecast_date"], "left")
            .withColumn("actual_qty", F.coalesce("actual_qty", F.lit(0))))
