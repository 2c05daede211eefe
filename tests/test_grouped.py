"""A user's model of one series, registered, beside series on which it fails."""

import numpy as np
import pandas as pd
import pytest
from conftest import by_key, panel, walk
from pyspark.sql import functions as F

from barline.operators import forecast, registry
from barline.operators.grouped import grouped
from barline.plans.preprocess import preprocess
from barline.sources.layout import cut_lineage


def functions():
    """Defined inside, so that they travel by value: workers do not have this file."""
    def fit(frame):
        name, y = frame["series"][0], frame["close"].to_numpy()
        assert list(frame.columns) == ["series", "date", "split", "close"] and frame["date"].is_monotonic_increasing
        if name == "raises":
            raise RuntimeError("no luck")
        if name == "empty":
            return {}
        if name == "infinite":
            return {"last": np.inf}
        return {"last": y[-1], "slope": [np.mean(np.diff(y))], "kind": [float(name == "late"), float(name == "shape")]}

    def predict(params, horizon, confidence):
        late, shape = params["kind"]
        if late and horizon > 1:
            raise ValueError("too far")
        if shape:
            return np.zeros(horizon + 1)
        path = params["last"][0] + params["slope"][0] * np.arange(1, horizon + 1)
        return np.column_stack([path, path - confidence, path + confidence])

    return fit, predict


@pytest.fixture(scope="module")
def prepared(spark):
    names = ["A", "B", "raises", "empty", "infinite", "late", "shape"]
    p = preprocess(panel(spark, {n: walk(300, i) for i, n in enumerate(names)}), min_rows=20)
    return cut_lineage(p.scaled), cut_lineage(p.scaler)


def test_errors_are_rows_and_the_others_go_on(prepared):
    scaled, scaler = prepared
    registry.register(grouped("drift_g", *functions(), ["close"]))
    params = cut_lineage(registry.fit("drift_g", scaled))
    got = by_key(params, "series")
    assert {s: r.error for s, r in got.items()} == {
        "A": None, "B": None, "late": None, "raises": "RuntimeError: no luck", "empty": "TypeError: fit must return a dict that is not empty, got dict",
        "infinite": "ValueError: parameter 'last' is no list of finite numbers", "shape": "ValueError: predict must return 1 values or rows of three, got shape (2,)"}
    assert got["raises"].params is None and set(got["A"].params) == {"last", "slope", "kind"}

    known = scaled.where("split <> 'test'").select("series", "date", "close").toPandas().sort_values("date")
    steps = registry.get("drift_g").forecast(params, 4, 0.9).toPandas().sort_values(["series", "step"])
    assert steps.groupby("series").size().to_dict() == {"A": 4, "B": 4, "late": 4}
    for name in ("A", "B"):
        y = known[known.series == name].close.to_numpy()
        mine = steps[steps.series == name]
        assert got[name].fit_end == known[known.series == name].date.max()
        assert mine.forecast.to_numpy() == pytest.approx(y[-1] + np.diff(y).mean() * np.arange(1, 5))
        assert (mine.upper - mine.forecast).to_numpy() == pytest.approx(np.full(4, 0.9))
    assert steps[steps.series == "late"][["forecast", "lower", "upper"]].isna().all().all()

    wide = forecast.forecast_all(params, scaled, scaler, ["drift_g"], 4)
    assert {r.series for r in wide.select("series").distinct().collect()} == {"A", "B"}
    asked = params.withColumn("n", F.when(F.col("series") == "A", 2).when(F.col("series") == "B", 0))
    assert registry.get("drift_g").point(asked, F.col("n")).count() == 2


def test_empty_tables_and_paths_without_band(prepared):
    scaled, _ = prepared
    model = grouped("flat_g", lambda frame: {"last": frame["close"].iloc[-1]}, lambda p, h, c: np.full(h, p["last"][0]), ["close"])
    params = cut_lineage(model.fit(scaled, origin="last"))
    assert params.where("error IS NOT NULL").count() == 0
    rows = model.forecast(params, 3).collect()
    assert len(rows) == 21 and all(r.forecast == r.lower == r.upper for r in rows)
    assert model.fit(scaled.limit(0)).count() == 0 and model.forecast(params.limit(0), 3).count() == 0
    ends = scaled.groupBy("series").agg(F.max("date").alias("d"))
    assert params.join(ends, "series").where("fit_end <> d").count() == 0
    assert isinstance(model.forecast(params, 1).toPandas(), pd.DataFrame)
