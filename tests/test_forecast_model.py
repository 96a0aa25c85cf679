"""ML-06: sparse trend, coordinate descent, simulated intervals."""

import numpy as np
import pandas as pd
import pytest

from mercato.operators import forecast as FC


def _series(y, start="2020-01-01"):
    return pd.DataFrame({"product_id": 7, "order_date": pd.date_range(start, periods=len(y)).date, "y": y})


def test_coordinate_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 11))])
    y = x @ np.array([3, -2, 0, 0, 0, 1.5, 0, 0, 0, 0, 0, 0.0]) + rng.normal(0, 0.5, 300)
    l1, l2 = np.r_[np.zeros(4), np.full(8, 40.0)], np.r_[np.full(4, 0.5), np.zeros(8)]
    beta, sigma = FC.sparse_fit(x, y, l1, l2, sweeps=2000, tol=1e-10)
    assert sigma == pytest.approx(np.std(y - x @ beta), rel=0.05)
    pull = (x.T @ (y - x @ beta)) / sigma**2 - l2 * beta  # gradient of the smooth part
    on = beta != 0
    assert np.allclose(pull[on], (l1 * np.sign(beta))[on], atol=0.5) and (abs(pull[~on]) <= l1[~on] + 1e-6).all()
    assert (beta[[6, 7, 8, 9, 10, 11]] == 0).sum() >= 4


def test_a_straight_trend_has_no_changepoints_and_a_bend_has_some():
    t = np.arange(900)
    noise = np.random.default_rng(2).normal(0, 0.5, 900)

    def hinges(y):
        cps = np.linspace(0, 0.8 * 899, FC.N_CHANGEPOINTS + 1)[1:]
        x = FC._design(t.astype(float), cps, 899.0)
        l1, l2 = np.zeros(x.shape[1]), np.full(x.shape[1], 0.04)
        l1[2:27], l2[2:27], l2[27:] = 20.0, 0.0, 0.01
        return FC.sparse_fit(x, y / y.max(), l1, l2)[0][2:27]

    straight, bent = hinges(20 + 0.02 * t + noise), hinges(20 + 0.1 * np.maximum(0, t - 450) + noise)
    assert (straight == 0).sum() >= 18
    assert abs(bent).max() > 5 * abs(straight).max()
    assert 8 <= abs(bent).argmax() <= 18  # near the middle of 25 over 80 % of the history


def test_intervals_cover_their_share_of_held_out_days():
    rng, inside, days = np.random.default_rng(3), 0, 0
    for k in range(12):
        t = np.arange(820)
        y = np.round(60 + 8 * np.sin(2 * np.pi * t / 7) + 0.02 * t * (k % 3) + rng.normal(0, 6, 820)).clip(0)
        out = FC.fit_predict(_series(y[:730]), 90, 30)
        inside += ((out.forecast_qty_lower <= y[730:]) & (y[730:] <= out.forecast_qty_upper)).sum()
        days += 90
        assert abs(out.forecast_qty - y[730:]).mean() < 8  # noise alone gives 4.8
    assert 0.74 < inside / days < 0.92


def test_interval_widens_where_the_trend_bends():
    t = np.arange(800)
    rng = np.random.default_rng(4)
    bends = 100 + 0.3 * abs((t % 200) - 100) + rng.normal(0, 1, 800)
    straight = 100 + rng.normal(0, 1, 800)
    width = lambda y: (lambda o: (o.forecast_qty_upper - o.forecast_qty_lower).to_numpy())(FC.fit_predict(_series(y), 90, 30))
    bent, flat = width(bends), width(straight)
    assert bent[-1] > 1.3 * bent[0] and flat[-1] < 1.2 * flat[0]


def test_reruns_agree_and_days_without_sale_count():
    pdf = _series([4.0] * 60)
    sparse = pdf.iloc[::2]
    a, b = FC.fit_predict(sparse, 30, 30, last="2020-02-29"), FC.fit_predict(sparse, 30, 30, last="2020-02-29")
    assert a.equals(b) and str(a.forecast_date.iloc[0]) == "2020-03-01"
    assert a.forecast_qty.mean() < 3 < FC.fit_predict(sparse, 30, 30, zero_days=False).forecast_qty.mean()
    assert FC.fit_predict(sparse.head(29), 30, 30).status.iloc[0] == "skipped: 29 points"


def test_a_history_of_one_value():
    out = FC.fit_predict(_series([0.0] * 40), 10, 30)
    assert (out.status == "ok").all() and (out.forecast_qty == 0).all()
