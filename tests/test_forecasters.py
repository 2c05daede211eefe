import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from conftest import by_key, panel, walk
from pyspark.sql import functions as F

from barline.functions.numeric import z_value
from barline.operators import arima, decomposition, registry, sequence
from barline.operators.linear import gram_sums, solve, unpack
from barline.plans.preprocess import preprocess
from barline.plans.train import train_all
from barline.schema import FEATURES
from barline.sources.layout import cut_lineage
from barline.sources.tables import publish_tables, read_model_params, write_model_params


def labelled(values, start="2020-01-01"):
    n = len(values)
    where = np.arange(n)
    return pd.DataFrame({
        "date": pd.date_range(start, periods=n).date, "close": np.asarray(values, dtype=float),
        "split": np.select([where < 0.8 * n, where < 0.9 * n], ["train", "val"], "test"),
    })


def ma1(n, theta, rng):
    e = rng.normal(size=n + 1)
    return 2 + e[1:] + theta * e[:-1]


def ar2(n, rng):
    x, e = np.zeros(n), rng.normal(size=n)
    for t in range(2, n):
        x[t] = 0.5 * x[t - 1] + 0.3 * x[t - 2] + e[t]
    return x + 1


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(7)
    n = 1200
    steps = rng.normal(size=n)
    return {"ma1": ma1(n, 0.6, rng), "ar2": ar2(n, rng), "rw": 50 + np.cumsum(steps),
            "i2": np.cumsum(np.cumsum(steps)), "flat": np.full(n, 3.0), "short": np.arange(6.0)}


@pytest.fixture(scope="module")
def rows(spark, series):
    return cut_lineage(panel(spark, {k: labelled(v) for k, v in series.items()}))


def test_gram_sums_over_unsorted_keys(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    df = spark.createDataFrame([(f"s{i % 3}", *map(float, r)) for i, r in enumerate(x)],
                               "series string, a double, b double, c double, y double")
    got = by_key(gram_sums(df, F.array("a", "b", "c"), F.col("y")), "series")
    for i in range(3):
        part = x[i::3]
        m = np.column_stack([np.ones(len(part)), part])
        g = unpack([got[f"s{i}"].gram], 5)
        assert g[0] == pytest.approx(m.T @ m)
        assert solve(g[:, :-1, :-1], g[:, :-1, -1])[0][0] == pytest.approx(np.linalg.lstsq(m[:, :-1], m[:, -1], rcond=None)[0])


def test_gram_sums_skips_incomplete_rows(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0), ("A", None, 2.0), ("A", 3.0, None)], "series string, x double, y double")
    assert gram_sums(df, F.array("x"), F.col("y")).first().gram == [1.0, 1.0, 2.0, 1.0, 2.0, 4.0]


def kpss(x):
    n, e = len(x), x - x.mean()
    lags = int(3 * np.sqrt(n) / 13)
    s2 = e @ e / n + sum(2 / n * (1 - i / (lags + 1)) * (e[i:] @ e[:-i]) for i in range(1, lags + 1))
    return (np.cumsum(e) ** 2).sum() / n**2 / s2


def test_difference_order(rows, series):
    got = by_key(arima.difference_order(rows.where("split = 'train'")), "series")
    assert {s: r.d for s, r in got.items() if s != "short"} == {"ma1": 0, "ar2": 0, "rw": 1, "i2": 2, "flat": 0}
    for s in ("ma1", "ar2", "rw", "i2"):
        train = series[s][:960]
        assert got[s].kpss_level == pytest.approx(kpss(train), rel=1e-6)
        assert got[s].kpss_difference == pytest.approx(kpss(np.diff(train)), rel=1e-6)


def test_ar_coefficients_equal_least_squares(rows, series):
    got = by_key(arima.fit_arima(rows, order=(2, 0, 0)), "series")["ar2"].params
    y = series["ar2"][:960]
    want = np.linalg.lstsq(np.column_stack([np.ones(958), y[1:-1], y[:-2]]), y[2:], rcond=None)[0]
    assert [got["const"][0], *got["ar"][:2]] == pytest.approx(want, rel=1e-6)


@pytest.fixture(scope="module")
def fitted(rows):
    return cut_lineage(arima.fit_arima(rows))


def test_order_search_recovers_the_processes(fitted):
    got = by_key(fitted, "series")
    assert got["ma1"].params["ma"][0] == pytest.approx(0.6, abs=0.1) or got["ma1"].params["order"][0] > 0
    assert got["ar2"].params["order"][1] == 0 and got["rw"].params["order"][1] == 1 and got["i2"].params["order"][1] == 2
    assert got["flat"].params["order"] == [0.0, 0.0, 0.0] and got["flat"].params["const"] == pytest.approx([3.0])
    assert got["short"].params is None and got["short"].error in ("too few rows", "singular")
    for r in got.values():
        if r.params:
            assert np.abs(np.roots([1, *(-np.array(r.params["ar"]))])).max() < 1


def test_moving_average_term(rows):
    got = by_key(arima.fit_arima(rows, order=(0, 0, 1)), "series")["ma1"].params
    assert got["ma"][0] == pytest.approx(0.6, abs=0.08)


def walk_forward(p, steps):
    """Plain loop over the recursion, with the variance from cumulated psi weights."""
    _, d, _ = p["order"]
    w, e, y, dy = list(p["w"]), list(p["e"]), *p["last"]
    psi = [0.0] * 5
    c1 = c2 = var = 0.0
    out = []
    for k in range(steps):
        new = p["const"][0] + np.dot(p["ar"], w[:5]) + np.dot(p["ma"], e[:5])
        q = 1.0 if k == 0 else (p["ma"][k - 1] if k <= 5 else 0.0) + np.dot(p["ar"], psi[:5])
        w, e, psi = [new, *w], [0.0, *e], [q, *psi]
        c1 += q
        c2 += c1
        var += (q, c1, c2)[int(d)] ** 2
        if d == 0:
            y = new
        elif d == 1:
            y += new
        else:
            dy += new
            y += dy
        out.append((y, var))
    return out


def test_forecast_recursion_and_band(fitted):
    params = by_key(fitted.where("params is not null"), "series")
    got = arima.forecast_arima(fitted, 12, 0.9).toPandas().sort_values(["series", "step"])
    assert set(got.series) == {"ma1", "ar2", "rw", "i2", "flat"}
    for s, rows in got.groupby("series"):
        want = walk_forward(params[s].params, 12)
        half = z_value(0.9) * np.sqrt(params[s].params["sigma2"][0] * np.array([v for _, v in want]))
        assert rows.forecast.to_numpy() == pytest.approx([y for y, _ in want], rel=1e-9)
        assert (rows.upper - rows.forecast).to_numpy() == pytest.approx(half, rel=1e-6, abs=1e-9)


def test_horizon_may_differ_by_series(fitted):
    asked = fitted.withColumn("h", F.when(F.col("series") == "rw", 3).otherwise(7))
    got = {r.series: r.n for r in arima.forecast_arima(asked, F.col("h")).groupBy("series").agg(F.count("*").alias("n")).collect()}
    assert got["rw"] == 3 and got["ar2"] == 7


def test_long_and_ragged_horizons_equal_a_plain_loop(spark):
    """Work is linear in the horizon, and series of one batch may have different orders, tails and horizons."""
    orders = {"arma": ([1.0, 0.0, 1.0], [0.6], [0.3]), "drift": ([2.0, 1.0, 0.0], [0.4, -0.2], [0.0, 0.0]), "curve": ([0.0, 2.0, 1.0], [0.0], [-0.5])}
    rows = []
    for name, (order, ar, ma) in orders.items():
        pad = [0.0] * (len(ar) - 1)
        rows.append((name, "arima", {"order": order, "const": [0.0 if order[1] == 2 else 0.02], "ar": ar, "ma": ma, "sigma2": [0.5],
                                     "w": [0.3, *pad], "e": [0.1, *pad], "last": [1.5, 0.01]}))
    params = spark.createDataFrame(rows, "series string, model string, params map<string, array<double>>")
    h = F.when(F.col("series") == "arma", 8000).when(F.col("series") == "drift", 2000).when(F.col("series") == "curve", 3)
    got = arima.forecast_arima(params, h, 0.9).toPandas().sort_values(["series", "step"])
    assert got.groupby("series").size().to_dict() == {"arma": 8000, "drift": 2000, "curve": 3}
    for name, _, p in rows:
        whole = {**p, **{c: np.pad(p[c], (0, 5 - len(p[c]))) for c in ("ar", "ma", "w", "e")}}
        mine = got[got.series == name]
        want = walk_forward(whole, len(mine))
        assert mine.step.tolist() == list(range(1, len(mine) + 1))
        assert mine.forecast.to_numpy() == pytest.approx([y for y, _ in want], rel=1e-8)
        half = z_value(0.9) * np.sqrt(0.5 * np.array([v for _, v in want]))
        assert (mine.upper - mine.forecast).to_numpy() == pytest.approx(half, rel=1e-6)
    assert arima.forecast_arima(params, F.lit(None).cast("int")).count() == 0 and arima.forecast_arima(params.limit(0), 5).count() == 0


@pytest.fixture(scope="module")
def panel_scaled(spark):
    dates = pd.bdate_range("2018-01-01", periods=1500)
    day = (dates - pd.Timestamp("1970-01-01")).days.to_numpy()
    shape = (100 + 0.05 * np.arange(1500)) * (1 + 0.1 * np.sin(2 * np.pi * day / 365.25) + 0.05 * (dates.weekday == 2))
    seasonal = walk(1500, 1)
    for c, f in (("open", 0.99), ("high", 1.02), ("low", 0.97), ("close", 1.0)):
        seasonal[c] = shape * f + np.random.default_rng(1).normal(size=1500) * 0.2
    frames = {"seasonal": seasonal, "walk": walk(700, 2), "flat": walk(500, 3).assign(close=5.0), "few": walk(130, 4)}
    p = preprocess(panel(spark, frames))
    return cut_lineage(p.scaled)


def test_decomposition_finds_season_and_weekday(panel_scaled):
    params = cut_lineage(decomposition.fit_decomposition(panel_scaled))
    got = by_key(params, "series")
    assert got["seasonal"].params["season"][0] == pytest.approx(0.1, abs=0.02)  # first yearly sine
    fc = decomposition.forecast_decomposition(params, 10).toPandas()
    one = fc[fc.series == "seasonal"].sort_values("step")
    end = pd.Timestamp(got["seasonal"].fit_end)
    days = pd.bdate_range(end + pd.offsets.BDay(1), periods=10)
    ratio = one.forecast.to_numpy() / one.forecast.mean()
    wednesday = days.weekday == 2
    assert ratio[wednesday].mean() - ratio[~wednesday].mean() == pytest.approx(0.05, abs=0.02)
    assert ((one.lower <= one.forecast) & (one.forecast <= one.upper)).all()
    flat = fc[fc.series == "flat"]
    assert flat.forecast.to_numpy() == pytest.approx(np.full(10, 5.0), rel=1e-3)


def test_decomposition_keeps_its_width(panel_scaled):
    params = decomposition.fit_decomposition(panel_scaled.where("series = 'walk'"))
    fc = decomposition.forecast_decomposition(params, 3, 0.8).collect()
    assert all(r.width_mismatch for r in fc)
    assert not decomposition.width_mismatch(0.951)


def test_sequences_stay_inside_their_split(panel_scaled):
    sizes = by_key(panel_scaled.groupBy("series", "split").count(), "series", "split")
    windows = sequence.build_sequences(panel_scaled)
    got = by_key(windows.groupBy("series", "split").agg(F.count("*").alias("n")), "series", "split")
    for key, r in sizes.items():
        assert (got[key].n if key in got else 0) == max(r["count"] - 60, 0)
    part = panel_scaled.where("series = 'walk' and split = 'train'").orderBy("date").toPandas()
    first = windows.where("series = 'walk' and split = 'train'").orderBy("date").first()
    assert np.array(first.x) == pytest.approx(part[FEATURES].to_numpy()[:60])
    assert first.y == pytest.approx(part.close[60])


def test_last_sequence(panel_scaled):
    got = by_key(sequence.last_sequence(panel_scaled), "series")["walk"]
    part = panel_scaled.where("series = 'walk' and split <> 'test'").orderBy("date").toPandas()
    assert np.array(got.x) == pytest.approx(part[FEATURES].to_numpy()[-60:])
    assert got.fit_end == part.date.iloc[-1]


@pytest.fixture(scope="module")
def sequence_params(panel_scaled):
    return cut_lineage(sequence.fit_sequence_regression(panel_scaled))


def whole(params, series):
    """Parameters of a series with what it shares."""
    rows = by_key(params, "series")
    return {**rows[None].params, **rows[series].params}


def test_pooled_ridge_equals_numpy(panel_scaled, sequence_params):
    def design(split):
        w = sequence.build_sequences(panel_scaled).where(F.col("split") == split).toPandas()
        x = np.stack([np.concatenate([np.asarray(r) for r in m]) for m in w.x])
        return x, w.y.to_numpy() - x[:, -len(FEATURES)]

    x, t = design("train")
    xv, tv = design("val")
    mean, shift = x.mean(0), t.mean()
    best = None
    for penalty in sequence.PENALTIES:
        c = x - mean
        w = np.linalg.solve(c.T @ c + penalty * len(x) * np.eye(x.shape[1]), c.T @ (t - shift))
        loss = ((tv - shift - (xv - mean) @ w) ** 2).mean()
        if best is None or loss < best[0]:
            best = (loss, penalty, w)
    got = whole(sequence_params, "walk")
    assert got["penalty"][0] == best[1]
    assert np.array(got["coef"]) == pytest.approx(best[2], rel=1e-4, abs=1e-8)
    assert got["const"][0] == pytest.approx(shift)


def test_short_train_split_is_an_error(spark):
    p = preprocess(panel(spark, {"A": walk(400, 5), "B": walk(105, 6)}), min_rows=20)
    got = by_key(sequence.fit_sequence_regression(p.scaled), "series")
    assert got["A"].error is None and got["B"].params is None and "look-back" in got["B"].error


def test_recursive_forecast_equals_a_loop(sequence_params):
    p = whole(sequence_params, "walk")
    window = np.array(p["window"]).reshape(60, len(FEATURES))
    want = []
    for _ in range(8):
        value = window[-1, 0] + p["const"][0] + (window.ravel() - p["mean"]) @ np.array(p["coef"])
        new = window[-1].copy()
        new[0] = value
        window = np.vstack([window[1:], new])
        want.append(value)
    got = sequence.forecast_recursive(sequence_params, 8).where("series = 'walk'").orderBy("step").toPandas()
    assert got.forecast.to_numpy() == pytest.approx(want)
    assert list(got.step) == list(range(1, 9))


def test_stochastic_passes_repeat_exactly(sequence_params):
    a = sequence.stochastic_forecast(sequence_params, 4).orderBy("series", "step").collect()
    b = sequence.stochastic_forecast(sequence_params.repartition(3), 4).orderBy("series", "step").collect()
    for x, y in zip(a, b):
        assert (x.series, x.step) == (y.series, y.step)
        assert [x.forecast, x.lower, x.upper] == pytest.approx([y.forecast, y.lower, y.upper], rel=1e-12)
    passes = sequence.fan_out_stochastic(sequence_params, 2, passes=7)
    assert passes.where("series = 'walk'").count() == 14
    still = sequence.stochastic_forecast(sequence_params, 4, dropout=0.0).where("series = 'walk'").orderBy("step").toPandas()
    point = sequence.forecast_recursive(sequence_params, 4).where("series = 'walk'").orderBy("step").toPandas()
    assert still.forecast.to_numpy() == pytest.approx(point.forecast.to_numpy())
    assert (still.upper - still.lower).to_numpy() == pytest.approx(np.zeros(4), abs=1e-9)


def test_coefficients_are_stored_once(spark, tmp_path):
    """A later series takes them as they are; those that a series has itself go before; tables keep one row of each key."""
    path = f"{tmp_path}/params"
    prepared = preprocess(panel(spark, {"A": walk(400, 5), "B": walk(420, 6), "C": walk(300, 7)}), min_rows=20).scaled
    first = prepared.where("series <> 'C'")
    for _ in range(2):
        params, report = train_all(first, path, ["lstm"])
        assert {r.series for r in report.where("success").collect()} == {"A", "B"}
    before = by_key(read_model_params(spark, path), "series")
    assert sorted(before, key=str) == ["A", "B", None] and sum("coef" in r.params for r in before.values()) == 1
    params, report = train_all(prepared, path, ["lstm"], overwrite=False)
    after = by_key(params, "series")
    assert params.count() == 4 and report.where("success").count() == 3 and all(after[k].params == r.params for k, r in before.items())
    window = sequence.last_sequence(prepared.where("series = 'C'")).first().x
    assert after["C"].params == {"window": [v for row in window for v in row], "shape": [60.0, 13.0, 0.0]}
    chosen = read_model_params(spark, path, ["C"])
    assert {r.series for r in chosen.collect()} == {"C", None}
    steps = sequence.forecast_recursive(chosen, 5).orderBy("step").toPandas()
    own = spark.createDataFrame([("C", "lstm", {**before[None].params, **after["C"].params, "const": [1.0]})], "series string, model string, params map<string, array<double>>")
    moved = sequence.forecast_recursive(own.unionByName(chosen.select(*own.columns).where("series IS NULL")), 1).first().forecast
    assert len(steps) == 5 and moved == pytest.approx(steps.forecast[0] + 1.0 - before[None].params["const"][0])
    root, copy = str(tmp_path), f"{tmp_path}/copy"
    write_model_params(read_model_params(spark, path), f"{root}/model_params")
    assert by_key(publish_tables(spark, root, copy, ["model_params"], ["A"]), "table")["model_params"].status == "copied"
    assert {r.series for r in read_model_params(spark, f"{copy}/model_params").collect()} == {"A", None}


def test_a_fit_without_windows_shares_nothing(spark):
    prepared = preprocess(panel(spark, {"A": walk(105, 5)}), min_rows=20).scaled
    rows = sequence.fit_sequence_regression(prepared).collect()
    assert [(r.series, r.params) for r in rows] == [("A", None)] and "look-back" in rows[0].error


def test_passes_and_moments_equal_a_plain_loop(spark):
    """Series of two shapes and of different horizons in one table; 20 passes make two blocks whose moments are merged."""
    rng = np.random.default_rng(5)
    rows, h = [], {"a": 6, "b": 2, "c": 4, "none": 0}
    for name, look_back, k in (("a", 3, 2), ("b", 3, 2), ("c", 2, 3), ("none", 3, 2)):
        width = look_back * k
        rows.append((name, "lstm", {"window": rng.random(width).tolist(), "coef": rng.normal(0, 0.2, width).tolist(), "mean": [0.5] * width,
                                    "const": [0.01], "shape": [float(look_back), float(k), 1.0]}))
    params = spark.createDataFrame(rows, "series string, model string, params map<string, array<double>>").unionByName(
        spark.createDataFrame([("unfit", "lstm", None)], "series string, model string, params map<string, array<double>>")).coalesce(1)
    steps = F.coalesce(*(F.when(F.col("series") == s, n) for s, n in h.items()))

    def mixed(x):
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            x = (x ^ (x >> shift)) * factor % 2**32
        return x ^ (x >> 16)

    want = {}
    for name, _, p in rows:
        k, target, width = int(p["shape"][1]), int(p["shape"][2]), len(p["coef"])
        for number in range(1, 21):
            key = int(hashlib.md5(f"{name}|{number}|7".encode()).hexdigest()[:8], 16)
            window = list(p["window"])
            for step in range(1, h[name] + 1):
                at = mixed((key + step * 0x9E3779B9) % 2**32)
                keep = [mixed((at + j * 0x9E3779B9) % 2**32) >= int(0.3 * 2**32) for j in range(width)]
                new = window[-k:]
                new[target] += p["const"][0] + sum((x - m) * c / 0.7 for x, m, c, z in zip(window, p["mean"], p["coef"], keep) if z)
                window = window[k:] + new
                want[name, number, step] = new[target]
    got = {(r.series, r["pass"], r.step): r.value for r in sequence.fan_out_stochastic(params, steps, 20, 0.3, 7).collect()}
    assert got == pytest.approx(want, rel=1e-12)
    found = {(r.series, r.step): (r.forecast, r.upper) for r in sequence.stochastic_forecast(params, steps, 0.9, 20, 0.3, 7).collect()}
    assert len(found) == 12
    for (name, step), (mean, upper) in found.items():
        values = [want[name, i, step] for i in range(1, 21)]
        assert mean == pytest.approx(np.mean(values), rel=1e-10) and upper - mean == pytest.approx(z_value(0.9) * np.std(values), rel=1e-8)
    plan = sequence.stochastic_forecast(params, steps)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("(?<!Broadcast)Exchange", plan)  # one row of coefficients is all that moves


def test_hash_masks_keep_their_share():
    keys = np.arange(40, dtype="uint32").reshape(4, 10)
    kept = np.stack([sequence.kept(keys, step, 500, 0.2) for step in range(1, 11)])
    assert kept.mean() == pytest.approx(0.8, abs=0.003)
    assert np.abs(kept.mean(axis=(1, 2, 3)) - 0.8).max() < 0.02 and np.abs(kept.mean(axis=(0, 1, 2)) - 0.8).max() < 0.1
    flat = kept.reshape(-1, 500).astype(float)
    assert np.abs(np.corrcoef(flat[:, :20].T) - np.eye(20)).max() < 0.25


def test_registry(fitted):
    with pytest.raises(ValueError):
        registry.get("nothing")
    lines = by_key(registry.model_summary(fitted), "series")
    assert lines["rw"].summary.startswith("ARIMA(rw): order=(") and lines["short"].summary == "ARIMA(short): not fitted"
