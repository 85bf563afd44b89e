import numpy as np
import pytest

from parcelwise.operators import forecast


def monthly_of(spark, series):
    rows = [
        (f"{2000 + i // 12}-{i % 12 + 1:02d}", region, float(v))
        for region, values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "year_month string, region_name string, late_risk_pct double"
    ).repartition(5)


def exact_objective(w, phi, theta):
    """-2 log likelihood of ARMA(1,1), without constants, from the full covariance matrix."""
    n = len(w)
    gamma = np.empty(n)
    gamma[0] = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    gamma[1] = (1 + phi * theta) * (phi + theta) / (1 - phi**2)
    for k in range(2, n):
        gamma[k] = phi * gamma[k - 1]
    cov = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    squares = w @ np.linalg.solve(cov, w)
    return n * np.log(squares / n) + np.linalg.slogdet(cov)[1], squares / n, cov


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(5)
    noise = rng.normal(size=400)
    w = np.zeros(400)
    for t in range(1, 400):
        w[t] = 0.6 * w[t - 1] + noise[t] - 0.3 * noise[t - 1]
    return {
        "arma": 50 + np.cumsum(w),
        "white": 40 + 5 * rng.normal(size=60),
        "walk": 50 + np.cumsum(rng.normal(size=60)),
        "flat": np.full(20, 33.0),
        "eleven": rng.uniform(0, 100, 11),
        "twelve": rng.uniform(0, 100, 12),
    }


def test_series_are_ordered_and_short_ones_skipped(spark, series):
    found = forecast.region_series(monthly_of(spark, series)).persist()
    by_region = {r["region_name"]: r for r in found.collect()}
    assert by_region["white"]["y"] == list(series["white"])
    eligible = {r["region_name"]: r["is_eligible"] for r in forecast.forecast_eligibility(found).collect()}
    assert eligible["twelve"] and not eligible["eleven"]


def test_fit_is_the_best_exact_likelihood(spark, series):
    fits = {r["region_name"]: r for r in forecast.arima_fit(forecast.region_series(monthly_of(spark, series))).collect()}
    assert "eleven" not in fits
    assert abs(fits["arma"]["phi"] - 0.6) < 0.2 and abs(fits["arma"]["theta"] + 0.3) < 0.2
    for region in ("white", "walk", "twelve"):
        w = np.diff(series[region])
        best, sigma2, cov = exact_objective(w, fits[region]["phi"], fits[region]["theta"])
        assert fits[region]["sigma2"] == pytest.approx(sigma2, rel=1e-9)
        grid = [i / 20 for i in range(-19, 20)]
        others = min(exact_objective(w, p, q)[0] for p in grid for q in grid)
        assert best <= others + 1e-7
    assert (fits["flat"]["phi"], fits["flat"]["theta"], fits["flat"]["sigma2"]) == (0.0, 0.0, 0.0)


def test_forecast_equals_conditional_gaussian(spark, series):
    """Mean and variance of the next three levels given the series, from covariances."""
    data = forecast.region_series(monthly_of(spark, {"walk": series["walk"]}))
    fits = forecast.arima_fit(data).persist()
    fit = fits.first()
    w = np.diff(series["walk"])
    n = len(w)
    _, sigma2, cov = exact_objective(np.append(w, [0, 0, 0]), fit["phi"], fit["theta"])
    sigma2 = fit["sigma2"]
    weights = np.linalg.solve(cov[:n, :n], cov[:n, n:]).T
    mean = weights @ w
    left = cov[n:, n:] - weights @ cov[:n, n:]
    rows = forecast.forecast_from_fit(fits).orderBy("forecast_step").collect()
    for h, row in enumerate(rows, start=1):
        ones = np.ones(h)
        centre = series["walk"][-1] + mean[:h].sum()
        reach = 1.959963984540054 * np.sqrt(sigma2 * ones @ left[:h, :h] @ ones)
        assert row["forecast_month"] == f"T+{h}"
        assert row["predicted_risk"] == pytest.approx(np.clip(centre, 0, 100), abs=0.0051)
        assert row["lower_bound"] == pytest.approx(max(0, centre - reach), abs=0.0051)
        assert row["upper_bound"] == pytest.approx(min(100, centre + reach), abs=0.0051)


def test_flat_series_and_clamps(spark):
    data = monthly_of(spark, {"flat": [100.0] * 15, "low": [50.0 - 4 * i for i in range(13)]})
    rows = forecast.forecast_risk_by_region(data).collect()
    flat = [r for r in rows if r["region_name"] == "flat"]
    assert {(r["predicted_risk"], r["lower_bound"], r["upper_bound"]) for r in flat} == {(100.0, 100.0, 100.0)}
    assert all(0 <= r["predicted_risk"] <= 100 and r["lower_bound"] >= 0 for r in rows)


def test_one_bad_region_does_not_stop_the_rest(spark, series):
    bad = list(series["white"])
    bad[-1] = float("nan")
    fits = forecast.arima_fit(forecast.region_series(monthly_of(spark, {"bad": bad, "walk": series["walk"]}))).persist()
    assert [r["region_name"] for r in forecast.forecast_failures(fits).collect()] == ["bad"]
    assert {r["region_name"] for r in forecast.forecast_from_fit(fits).collect()} == {"walk"}


def test_no_region_gives_an_empty_table_with_its_columns(spark, series):
    empty = forecast.forecast_risk_by_region(monthly_of(spark, {"eleven": series["eleven"]}))
    assert empty.collect() == []
    assert empty.columns == [
        "region_name", "forecast_step", "forecast_month", "predicted_risk", "lower_bound", "upper_bound"
    ]
