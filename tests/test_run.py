import datetime
import os

import pytest
from conftest import by_key, panel, walk
from pyspark.sql import functions as F

from barline.operators import forecast, pairs, registry
from barline.plans import run, train, views
from barline.plans.preprocess import preprocess
from barline.schema import BARS, FORECAST, MODEL_PARAMS
from barline.sources import bars as bar_tables
from barline.sources import tables
from barline.sources.layout import cut_lineage, load_series


def constant(name, error=None):
    """A model that forecasts the scaled value 0.5 with a band of 0.05 either way."""

    def fit(scaled):
        if error:
            raise RuntimeError(error)
        return scaled.groupBy("series").agg(F.max("date").alias("fit_end")).select(
            "series", F.lit(name).alias("model"), "fit_end",
            F.create_map(F.lit("value"), F.array(F.lit(0.5))).alias("params"), F.lit(None).cast("string").alias("error"))

    def predict(params, horizon, confidence=0.95):
        h = horizon if not isinstance(horizon, int) else F.lit(horizon)
        value = F.col("params")["value"][0]
        return params.select("series", "model", F.explode(F.sequence(F.lit(1), h)).alias("step"), value.alias("forecast"),
                             (value - 0.05).alias("lower"), (value + 0.05).alias("upper"))

    return registry.Forecaster(name, fit, predict, predict)


@pytest.fixture(scope="module", autouse=True)
def models():
    registry.register(constant("half"))
    registry.register(constant("other"))
    registry.register(constant("broken", "no luck"))


@pytest.fixture(scope="module")
def bars(spark):
    return cut_lineage(panel(spark, {"A": walk(400, 1), "B": walk(400, 2)}))


def test_forecast_table(spark, bars):
    p = preprocess(bars)
    params = train.fit_models(p.scaled, ["half", "other"])
    stamp = F.lit(datetime.datetime(2024, 1, 5, 1, 2, 3))
    wide = forecast.forecast_all(params, p.scaled, p.scaler, ["half", "other"], 10, generated_at=stamp).toPandas()
    assert len(wide) == 20 and set(wide.generated_at) == {"2024-01-05T01:02:03Z"}
    assert list(wide.columns[:5]) == ["series", "generated_at", "last_known_price", "last_known_date", "date"]
    middle = by_key(p.scaler.where("feature = 'close'"), "series")
    for s, rows in wide.groupby("series"):
        want = round((middle[s].data_min + middle[s].data_max) / 2, 2)
        assert rows.half_forecast.to_numpy() == pytest.approx([want] * 10, abs=0.011)
        assert all(d.weekday() < 5 for d in rows.date) and min(rows.date) > rows.last_known_date.iloc[0]
    for n in (5, 30):
        assert forecast.forecast_long(params, p.scaled, p.scaler, ["half"], n).groupBy("series").count().first()["count"] == n


def test_failed_model_leaves_nulls_and_series_without_model_is_absent(spark, bars):
    p = preprocess(bars)
    params = train.fit_models(p.scaled, ["half", "other"]).where("series = 'A' and model = 'half'")
    wide = forecast.forecast_all(params, p.scaled, p.scaler, ["half", "other"], 5).collect()
    assert {r.series for r in wide} == {"A"}
    assert all(r.other_forecast is None and r.half_forecast is not None for r in wide)


def test_benchmark_has_a_naive_row_per_series(spark, bars):
    p = preprocess(bars)
    params = train.fit_models(p.scaled, ["half", "other"])
    table, summary = train.run_benchmark(params, p.scaled, p.scaler, ["half", "other"])
    rows = by_key(table, "series", "model")
    assert len(rows) == 6 and rows[("A", "naive")].rmse_vs_naive_pct == 0.0
    assert summary.first().n_models == 2


def test_full_then_single_then_forecast_only(spark, bars, tmp_path):
    work = str(tmp_path / "work")
    first = run.run(spark, bars, work, models=["half", "arima"], horizon=5, publish_to=str(tmp_path / "out")).first()
    assert first.success and (first.series_fetched, first.series_trained, first.models_trained, first.series_forecast) == (2, 2, 4, 2)
    names = views.create_views(spark, work)
    assert {"v_forecast", "v_history_tail", "v_benchmark", "v_benchmark_pivot", "v_kpi"} <= set(names)
    assert spark.table("v_forecast").count() == 10
    restored = tables.read_forecast(spark, f"{tmp_path}/out/forecasts", "A")
    assert restored.count() == 5

    def stamp():
        return {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{work}/model_params") for f in fs if f.endswith("parquet")}

    before = stamp()
    single = run.run(spark, bars, work, mode="single", series=["A"], models=["half", "arima"], horizon=5).first()
    assert single.success and single.models_trained == 2 and stamp() == before
    assert load_series(spark, f"{work}/forecasts").select("series").distinct().count() == 2

    only = run.run(spark, bars, work, mode="forecast_only", models=["half", "arima"], horizon=5).first()
    assert only.success and only.models_trained == 0 and only.avg_rmse_reduction == 0.0 and stamp() == before


def test_one_failing_model_does_not_stop_the_others(spark, bars, tmp_path):
    got = run.run(
        spark, bars, str(tmp_path), models=["broken", "half"], horizon=3, with_benchmark=False,
        as_of=datetime.date(2019, 7, 1),
    ).first()
    assert got.success and got.models_trained == 2
    assert load_series(spark, f"{tmp_path}/bars").agg(F.max("date")).first()[0] < datetime.date(2019, 7, 1)
    report = by_key(spark.read.json(f"{tmp_path}/training_report"), "series", "model")
    assert not report[("A", "broken")].success and report[("A", "broken")].error == "no luck"
    totals = spark.read.json(f"{tmp_path}/training_totals").first()
    assert (totals.total, totals.success, totals.failed) == (4, 2, 2)


def test_runs_that_cannot_succeed(spark, bars, tmp_path):
    with pytest.raises(ValueError):
        run.run(spark, bars, str(tmp_path), mode="sometimes")
    empty = run.run(spark, spark.createDataFrame([], BARS), f"{tmp_path}/a").first()
    assert not empty.success and empty.errors == [run.NO_DATA]
    tiny = run.run(spark, panel(spark, {"A": walk(60)}), f"{tmp_path}/b", min_rows=10).first()
    assert not tiny.success and tiny.errors[-1] == run.NO_FEATURES
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/b/rejected").collect()] == [("A", "preprocess", "too few complete rows")]
    unfitted = run.run(spark, bars, f"{tmp_path}/c", mode="forecast_only", models=["half"]).first()
    assert not unfitted.success and unfitted.series_forecast == 0
    wanted = pairs.all_pairs(bars.select("series").distinct(), ["half"])
    assert run.promoted_mode(spark, f"{tmp_path}/c", "forecast_only", wanted) == "full"


def test_csv_files_by_header_name(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for s, seed in (("AAA", 1), ("B.B", 2)):
        frame = walk(30, seed).rename(columns=str.capitalize)[["Date", "Close", "High", "Low", "Open", "Volume"]]
        frame.loc[3, "Close"] = None
        frame.to_csv(folder / f"{s}.csv", index=False)
    got = bar_tables.read_bars(spark, str(folder))
    assert got.columns == ["series", "date", "open", "high", "low", "close", "volume", "ingest_ordinal"]
    assert {r.series: (r.n, r.k) for r in got.groupBy("series").agg(F.count("*").alias("n"), F.count("close").alias("k")).collect()} == {
        "AAA": (30, 29), "B.B": (30, 29)}
    one = walk(30, 1)
    assert got.where("series = 'AAA'").agg(F.sum("open")).first()[0] == pytest.approx(one.open.sum())
    universe = pairs.universe_table(spark, ["AAA", "ZZZ"])
    assert {r.series for r in bar_tables.read_panel(spark, str(folder), universe).collect()} == {"AAA"}
    now = datetime.datetime.fromtimestamp(os.path.getmtime(folder / "AAA.csv"), datetime.timezone.utc).replace(tzinfo=None)
    old = os.path.getmtime(folder / "AAA.csv") - 25 * 3600
    os.utime(folder / "B.B.csv", (old, old))
    names = pairs.universe_table(spark, ["AAA", "B.B", "ZZZ"])
    assert {r.series for r in bar_tables.stale_series(spark, str(folder), names, now).collect()} == {"B.B", "ZZZ"}
    assert bar_tables.stale_series(spark, str(folder), names, now, force=True).count() == 3
    assert bar_tables.stale_series(spark, str(tmp_path / "none"), names, now).count() == 3


def test_writing_some_series_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "bars")
    names = {f"s{i}": walk(20, i) for i in range(12)}
    bar_tables.write_bars(panel(spark, names), path, buckets=4)
    bar_tables.write_bars(panel(spark, {"s3": walk(7, 99), "new": walk(5, 1)}), path)
    got = {r.series: r.n for r in load_series(spark, path).groupBy("series").agg(F.count("*").alias("n")).collect()}
    assert got == {**{s: 20 for s in names}, "s3": 7, "new": 5}
    assert load_series(spark, path, ["s3", "new"]).count() == 12
    plan = load_series(spark, path, ["s3"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_missing_and_malformed_tables(spark, tmp_path):
    assert tables.read_benchmark(spark, f"{tmp_path}/none") is None
    (tmp_path / "bad.csv").write_text("ticker,model\nA,x\n")
    assert tables.read_benchmark(spark, f"{tmp_path}/bad.csv") is None
    assert tables.read_all_forecasts(spark, f"{tmp_path}/x", f"{tmp_path}/y") is None
    assert tables.read_model_params(spark, f"{tmp_path}/x") is None
    assert tables.artifact_manifest(spark, f"{tmp_path}/x").count() == 0


def test_publish_reports_each_table(spark, bars, tmp_path):
    src, dst = f"{tmp_path}/src", f"{tmp_path}/dst"
    bar_tables.write_bars(bars, f"{src}/bars")
    os.makedirs(f"{src}/benchmark")
    (tmp_path / "src" / "benchmark" / "part.csv").write_text("ticker,RMSE\nA,1\n")
    (tmp_path / "dst").mkdir()
    (tmp_path / "dst" / "bars").write_text("a file in the way")
    results = tables.publish_tables(spark, src, dst, ["bars", "benchmark", "scaler"])
    assert {r.table: r.status for r in results.collect()} == {"bars": "failed", "benchmark": "copied", "scaler": "absent"}
    outcome = tables.publish_outcome(results).first()
    assert (outcome.complete, outcome.usable) == (False, True)
    subset = tables.publish_tables(spark, src, f"{tmp_path}/part", ["bars"], series=["B"])
    assert subset.first().status == "copied"
    assert {r.series for r in load_series(spark, f"{tmp_path}/part/bars").collect()} == {"B"}


def test_schemas_are_kept(spark, bars):
    p = preprocess(bars)
    params = train.fit_models(p.scaled, ["arima", "half"])
    assert [f.dataType for f in params.schema] == [f.dataType for f in MODEL_PARAMS]
    fc = registry.get("arima").forecast(params.where("model = 'arima'"), 3, 0.95)
    assert fc.columns == FORECAST.names
