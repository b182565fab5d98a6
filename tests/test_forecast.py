from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from tallybook.plans import forecast as fc

ALL = tuple(m for m, _ in fc.MODELS)


def months(spark, **series):
    rows = []
    for name, values in series.items():
        for i, v in enumerate(values):
            rows.append((name, dt.date(2015 + i // 12, i % 12 + 1, 1), v))
    return spark.createDataFrame(rows, "series string, month_start date, orders long")


@pytest.fixture(scope="module")
def window(spark):
    return fc.complete_window(
        months(
            spark,
            constant=[50] * 24,
            short=[10] * 14,
            zero_at_end=[10] * 20 + [1, 0, 10],
            ties=[100] * 15 + [0] + [101] * 15,
            edges=[1, 100, 2] + [100 + i for i in range(20)] + [3, 1],
        )
    ).cache()


def used(window, name):
    return [r.month_start.strftime("%Y-%m") for r in window.where(f"series = '{name}' and used").orderBy("month_start").collect()]


def test_longest_run_of_complete_months(window):
    months_ = used(window, "edges")
    assert months_[0] == "2015-04" and len(months_) == 20


def test_first_run_wins_a_tie(window):
    months_ = used(window, "ties")
    assert (months_[0], len(months_)) == ("2015-01", 15)


def test_skipped_series(window):
    got = {r.series: r for r in fc.run_forecast(window, ALL).collect()}
    assert got["short"].skipped and got["short"].winner is None
    assert not got["constant"].skipped and got["constant"].winner_mape_pct == 0.0


def test_zero_in_the_holdout_is_skipped(spark):
    # a zero cannot be inside a window of complete months unless the median is zero
    w = fc.complete_window(months(spark, z=[0] * 20))
    assert fc.run_forecast(w).first().skipped


def test_simple_forecasts_by_hand(spark):
    values = [100, 110, 120, 130, 140, 150, 160, 170, 180, 190, 200, 210, 220, 230, 240, 250, 260, 270]
    u = fc.usable(fc.complete_window(months(spark, s=values)))
    got = {(r.model, r.h): r.predicted for r in fc.simple_forecasts(u, 3).collect()}
    assert [got["naive_last_value", h] for h in (1, 2, 3)] == [240.0] * 3
    assert [got["seasonal_naive_12m", h] for h in (1, 2, 3)] == [130.0, 140.0, 150.0]
    assert [got["moving_average_3m", h] for h in (1, 2, 3)] == [230.0] * 3
    held = fc.holdout_rows(u)
    score = {r.model: r.holdout_mape_pct for r in fc.scores(held).collect()}
    want = np.mean([abs(a - 240) / a for a in (250, 260, 270)]) * 100
    assert score["naive_last_value"] == round(want, 2)


def test_ties_go_to_the_first_model(spark):
    w = fc.complete_window(months(spark, s=[50] * 24))
    row = fc.run_forecast(w, ALL).first()
    assert (row.winner, row.best_baseline, row.best_model) == ("naive_last_value", "naive_last_value", "moving_average_3m")
    assert row.baseline_wins and row.model_minus_baseline_mape_pp == 0.0


def test_table_has_actual_holdout_and_forecast(window):
    t = fc.forecast_table(window, ALL)
    kinds = {(r.series, r.row_type): r["count"] for r in t.groupBy("series", "row_type").count().collect()}
    assert kinds["constant", "holdout"] == 12 and kinds["constant", "forecast"] == 3 and kinds["constant", "actual"] == 24
    assert ("short", "forecast") not in kinds
    assert t.where("series = 'short' and used_in_model").count() == 0
    ahead = t.where("series = 'constant' and row_type = 'forecast'").orderBy("month_start").collect()
    assert [(r.month, r.orders) for r in ahead] == [("2017-01", 50), ("2017-02", 50), ("2017-03", 50)]


def test_months_without_orders_count_zero(spark):
    orders = spark.createDataFrame([("a", 20180105), ("b", 20180401), ("c", 20180402)], "order_id string, purchase_date_key int")
    dates = spark.createDataFrame([(20180105, dt.date(2018, 1, 1)), (20180401, dt.date(2018, 4, 1)), (20180402, dt.date(2018, 4, 1))],
                                  "date_key int, month_start date")
    got = [(r.month_start.month, r.orders) for r in fc.monthly_orders(orders, dates).orderBy("month_start").collect()]
    assert got == [(1, 1), (2, 0), (3, 0), (4, 2)]


def one_step_errors(y, alpha, beta, phi):
    """Least squared one-step error of fixed parameters, by solving for the start values with a design matrix."""

    def run(level, trend, y):
        out = []
        for v in y:
            seen = level + phi * trend
            out.append(v - seen)
            new = alpha * v + (1 - alpha) * seen
            level, trend = new, beta * (new - level) + (1 - beta) * phi * trend
        return np.array(out), level, trend

    plain = run(0.0, 0.0, y)[0]
    zero = np.zeros(len(y))
    design = -np.stack([run(1.0, 0.0, zero)[0], run(0.0, 1.0, zero)[0]], axis=1)
    start = np.linalg.lstsq(design, plain, rcond=None)[0]
    errors, level, trend = run(*start, y)
    return float((errors**2).sum()), level, trend


def trends(spark, horizon_months=0, **series):
    train = [(name, i + 1, int(v)) for name, values in series.items() for i, v in enumerate(values)]
    return {r.series: r.fit for r in fc.fitted_trends(spark.createDataFrame(train, "series string, idx int, orders long")).collect()}


def ahead(spark, values):
    u = fc.usable(fc.complete_window(months(spark, s=values)))
    return {r.h: r.predicted for r in fc.holt_forecasts(u, 0).collect()}


def test_holt_on_a_constant_series(spark):
    assert trends(spark, c=[70] * 24)["c"].sse < 1e-2
    assert np.allclose(list(ahead(spark, [70] * 24).values()), 70.0, atol=1e-3)


def test_holt_steps_shrink_by_phi(spark):
    values = [int(100 + 5 * i + 3 * np.sin(i)) for i in range(30)]
    got = ahead(spark, values)
    phi = trends(spark, s=values)["s"].phi
    assert (got[3] - got[2]) / (got[2] - got[1]) == pytest.approx(phi, abs=1e-4)


def test_holt_is_the_best_of_its_grids(spark):
    rng = np.random.default_rng(3)
    own = {"a": (rng.poisson(200, 40) + np.arange(40)).tolist(), "b": rng.poisson(5000, 15).tolist(), "d": (3 * np.arange(30) ** 2 + rng.poisson(50, 30)).tolist()}
    for name, fit in trends(spark, **own).items():
        y = np.array(own[name], dtype=float)
        sse, level, trend = one_step_errors(y, fit.alpha, fit.beta, fit.phi)
        assert fit.sse == pytest.approx(sse, rel=1e-4)  # the ridge on the start values
        grid = min(one_step_errors(y, a, b, p)[0] for a in fc.ALPHAS for b in fc.BETAS for p in fc.PHIS)
        assert fit.sse <= grid * (1 + 1e-4)
        got = ahead(spark, own[name])
        assert got[1] == pytest.approx(level + fit.phi * trend, rel=1e-6)


def test_no_python_runs_in_the_fits(spark, window):
    plan = fc.holdout_rows(fc.usable(window), ALL)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan and "Arrow" not in plan


def test_run_says_months_and_reasons(window):
    got = {r.series: r for r in fc.run_forecast(window, ALL).collect()}
    assert got["short"].reason == "only 14 complete months" and got["short"].train_months is None and got["short"].holdout_months is None
    edges = got["edges"]
    assert edges.train_months == 17 and edges.reason is None and edges.holdout_months == "2016-09,2016-10,2016-11"
    assert edges.excluded_months == "2015-01,2015-02,2015-03,2016-12,2017-01"
