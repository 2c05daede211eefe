"""The order search from autocovariances against NumPy: Yule-Walker equations, an LDL factor, plain recursions."""

import numpy as np
import pandas as pd
import pytest
from conftest import by_key
from pyspark.sql import functions as F

from barline.operators import arima, autocov
from barline.sources.layout import cut_lineage

N = 900


def simulate(ar, ma, seed, n=N):
    e = np.random.default_rng(seed).normal(size=n + 100)
    x = np.zeros(n + 100)
    for t in range(10, n + 100):
        x[t] = sum(a * x[t - i - 1] for i, a in enumerate(ar)) + e[t] + sum(b * e[t - i - 1] for i, b in enumerate(ma))
    return x[100:]


@pytest.fixture(scope="module")
def series():
    return {"ar2": 5 + simulate([0.5, 0.3], [], 1), "ma1": 2 + simulate([], [0.6], 2), "arma": 1 + simulate([0.7], [0.4], 3),
            "walk": np.cumsum(simulate([], [], 4) + 0.1), "flat": np.full(N, 3.0), "tiny": np.arange(2.0)}


@pytest.fixture(scope="module")
def rows(spark, series):
    parts = []
    for name, x in series.items():
        at = np.arange(len(x)) / N
        parts.append(pd.DataFrame({"series": name, "date": pd.date_range("2015-01-01", periods=len(x)).date, "close": x,
                                   "split": np.where(at < 0.7, "train", np.where(at < 0.85, "val", "test"))}))
    return cut_lineage(spark.createDataFrame(pd.concat(parts), "series string, date date, close double, split string"))


def gammas(x):
    x = x - x.mean()
    return np.array([x[k:] @ x[:len(x) - k] / len(x) for k in range(autocov.LAGS + 1)])


def test_predictors_and_innovations(spark, series):
    g = gammas(series["arma"][:630])
    df = spark.createDataFrame([(g.tolist(),), ([0.0] * 17,)], "g array<double>").withColumn("phi", autocov.durbin_levinson(F.col("g")))
    (phi, psi), (_, flat) = [tuple(r) for r in df.select("phi", autocov.innovations(F.col("phi"), 4)).collect()]
    toeplitz = g[np.abs(np.subtract.outer(np.arange(17), np.arange(17)))]
    for k in (1, 2, 7, 16):
        assert phi[k] == pytest.approx(np.linalg.solve(toeplitz[:k, :k], g[1:k + 1]), rel=1e-8, abs=1e-10)
    lower = np.linalg.cholesky(toeplitz)
    lower = lower / np.diag(lower)
    assert psi == pytest.approx([lower[16, 16 - j] for j in range(5)], rel=1e-8, abs=1e-10)
    assert flat == [1.0, 0.0, 0.0, 0.0, 0.0]


def test_elimination_needs_pivots_and_tells_singular_equations(spark):
    rng = np.random.default_rng(0)
    cases = [(rng.normal(size=(k, k)), rng.normal(size=k)) for k in (1, 2, 3, 5)] + [(np.array([[0.0, 2.0], [3.0, 1.0]]), np.array([1.0, 2.0]))]
    cases += [(np.zeros((2, 2)), np.ones(2))]
    df = spark.createDataFrame([(i, len(b), np.column_stack([a, b]).tolist()) for i, (a, b) in enumerate(cases)], "i int, k int, m array<array<double>>")
    got = {r.i: r.x for r in df.select("i", autocov.solve(F.col("m"), F.col("k")).alias("x")).collect()}
    for i, (a, b) in enumerate(cases[:-1]):
        assert got[i] == pytest.approx(np.linalg.solve(a, b), rel=1e-8)
    assert got[len(cases) - 1] is None


@pytest.mark.parametrize("coef", [[], [0.5], [1.2], [1.5, -0.6], [0.5, 0.6], [0.2, -0.3, 0.9], [0.1, 0.2, 0.3, 0.2]])
def test_stability_equals_roots(spark, coef):
    ok = spark.range(1).select(autocov.stable(F.array(*map(F.lit, coef)).cast("array<double>"))).first()[0]
    assert ok == (not coef or bool(np.abs(np.roots([1, *(-c for c in coef)])).max() < 1))


def test_fixed_orders(rows, series):
    x = series["ar2"][:630]
    got = by_key(autocov.fit_autocov(rows, order=(2, 0, 0)), "series")["ar2"].params
    g = gammas(x)
    phi = np.linalg.solve([[g[0], g[1]], [g[1], g[0]]], g[1:3])
    assert got["ar"] == pytest.approx(phi, rel=1e-8) and got["const"][0] == pytest.approx(x.mean() * (1 - phi.sum()), rel=1e-8)
    assert got["sigma2"][0] == pytest.approx((g[0] - phi @ g[1:3]) * 630 / 627, rel=1e-8)
    known = series["ar2"][:765]
    assert got["w"] == pytest.approx(known[[-1, -2]]) and got["last"][0] == pytest.approx(known[-1])
    centred = known - x.mean()
    assert got["e"][0] == pytest.approx(centred[-1] - phi @ centred[[-2, -3]], rel=1e-8)


def test_search_recovers_the_processes(rows, series):
    got = by_key(autocov.fit_autocov(rows, 2, 2), "series")
    order = {s: r.params["order"] for s, r in got.items() if r.params}
    assert order["ar2"][0] == 2 and order["walk"][1] == 1 and order["flat"] == [0, 0, 0] and got["tiny"].error == "too few rows"
    one = by_key(autocov.fit_autocov(rows, order=(1, 0, 1)), "series")["arma"].params
    assert one["ar"][0] == pytest.approx(0.7, abs=0.1) and one["ma"][0] == pytest.approx(0.4, abs=0.15)
    assert by_key(autocov.fit_autocov(rows, order=(0, 0, 1)), "series")["ma1"].params["ma"][0] == pytest.approx(0.6, abs=0.12)


def test_larger_grids_beat_no_smaller_one_and_forecast(rows):
    fitted = cut_lineage(autocov.fit_autocov(rows))
    small = by_key(autocov.fit_autocov(rows, 1, 1), "series")
    for s, r in by_key(fitted, "series").items():
        assert r.params is None or r.params["aic"][0] <= small[s].params["aic"][0] + 1e-9
    path = arima.forecast_arima(fitted, 40).toPandas()
    assert len(path) == 40 * 5 and np.isfinite(path.forecast).all() and (path.upper >= path.lower).all()


def test_two_exchanges_no_python_and_empty(rows):
    plan = autocov.fit_autocov(rows, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Python" not in plan and "Pandas" not in plan
    assert autocov.fit_autocov(rows.limit(0), 1, 1).count() == 0
    with pytest.raises(ValueError):
        autocov.fit_autocov(rows, order=(10, 0, 10))
