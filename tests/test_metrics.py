import pytest
from conftest import by_key, panel, walk
from pyspark.sql import functions as F

from barline.operators import forecast, metrics, pairs
from barline.plans.preprocess import preprocess
from barline.schema import MODEL_PARAMS

BENCH = "series string, model string, rmse double, mape double, mae double, rmse_vs_naive_pct double"


def pairs_of(spark, rows):
    return spark.createDataFrame([("A", "m", float(a), float(p)) for a, p in rows],
                                 "series string, model string, actual double, predicted double")


@pytest.mark.parametrize("rows, want", [
    ([(100, 100), (200, 200), (300, 300)], (0, 0, 0)),
    ([(100, 110), (100, 90)], (10, 10, 10)),
    ([(0, 5), (100, 90)], (62.5**0.5, 10, 7.5)),
    ([(0, 3), (0, 3)], (3, None, 3)),
])
def test_error_metrics(spark, rows, want):
    got = metrics.error_metrics(pairs_of(spark, rows)).first()
    assert [got.rmse, got.mape, got.mae] == [None if w is None else pytest.approx(w) for w in want]


def test_naive_repeats_the_value_before_and_first_itself(spark):
    rows = panel(spark, {"A": walk(5)}).select("series", "date", F.lit("test").alias("split"), F.col("close").alias("raw_close"))
    got = metrics.naive_forecast(rows).orderBy("date").toPandas()
    assert got.predicted[0] == got.actual[0]
    assert list(got.predicted[1:]) == list(got.actual[:-1])


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(s, m, r, 2.0, 3.0, p) for s in ("A", "B") for m, r, p in (
        ("naive", 4.5, 0.0), ("arima", 4.1, -9.0), ("prophet", 3.9, -14.0), ("lstm", 3.7, -18.0))]
    return spark.createDataFrame(rows, BENCH)


def test_summary(spark, bench):
    got = metrics.aggregate_summary(bench).first()
    assert (got.avg_rmse_reduction_pct, got.best_model_by_rmse, got.n_series, got.n_models, got.naive_avg_rmse) == (
        -13.67, "lstm", 2, 3, 4.5)
    assert got.best_model_by_mape == "arima"  # a tie goes to the first name
    assert got.model_avg_metrics["lstm"].rmse == 3.7
    assert metrics.aggregate_summary(bench.where("model = 'naive'")).count() == 0
    assert metrics.aggregate_summary(bench.limit(0)).count() == 0
    assert metrics.kpi_summary(bench).first().best_model == "LSTM"


def test_pivot_and_report_order(spark, bench):
    assert metrics.pivot_metric(bench).columns == ["series", "naive", "arima", "prophet", "lstm"]
    universe = pairs.universe_table(spark, ["B", "A"])
    report = metrics.ordered_report(bench, universe).collect()
    assert [(r.series, r.model) for r in report] == [(s, m) for s in "BA" for m in ("naive", "arima", "prophet", "lstm")]
    assert [(r.series, r.model) for r in report if r.marker == "best"] == [("B", "lstm")]


def test_display(spark, bench):
    row = by_key(metrics.format_benchmark(bench, "A"), "Model")
    assert set(row) == {"Naive", "ARIMA", "Prophet", "LSTM"}
    assert (row["Naive"]["vs Naive"], row["ARIMA"]["vs Naive"], row["ARIMA"]["RMSE ($)"], row["ARIMA"]["MAPE (%)"]) == (
        "baseline", "-9.0%", "4.1000", "2.00%")
    assert metrics.format_benchmark(bench, "unknown").count() == 8


def test_benchmark_rows(spark):
    naive = spark.createDataFrame([("A", "naive", 2.0, 1.0, 1.0), ("B", "naive", 0.0, 1.0, 1.0)], BENCH.rsplit(",", 1)[0])
    models = spark.createDataFrame([("A", "x", 1.5, 1.0, 1.0), ("B", "x", 1.0, 1.0, 1.0), ("C", "x", 1.0, 1.0, 1.0)],
                                   BENCH.rsplit(",", 1)[0])
    got = by_key(metrics.benchmark_table(models, naive), "series", "model")
    assert {k: r.rmse_vs_naive_pct for k, r in got.items()} == {
        ("A", "naive"): 0.0, ("A", "x"): -25.0, ("B", "naive"): 0.0, ("B", "x"): None}


def test_pairs(spark):
    wanted = pairs.all_pairs(spark.createDataFrame([("A",), ("B",)], "series string"), ["arima", "lstm"])
    params = spark.createDataFrame([("A", "arima", None, {"x": [1.0]}, None), ("B", "arima", None, None, "singular")], MODEL_PARAMS)
    got = by_key(pairs.attach_models(wanted, params), "series", "model")
    assert {k: r.status for k, r in got.items()} == {
        ("A", "arima"): "ok", ("A", "lstm"): "missing", ("B", "arima"): "failed", ("B", "lstm"): "missing"}
    assert len(pairs.untrained_pairs(params, wanted).collect()) == 3


def test_bands(spark):
    fc = spark.createDataFrame([("A", "m", 5.0, 6.0, 4.0), ("B", "m", 5.0, 4.0, 6.0)],
                               "series string, model string, forecast double, lower double, upper double")
    assert {r.series: r.ok for r in forecast.band_check(fc).collect()} == {"A": False, "B": True}
    assert all(r.ok for r in forecast.band_check(forecast.clamp_bands(fc)).collect())
    with pytest.raises(ValueError):
        forecast.check_request(0)
    with pytest.raises(ValueError):
        forecast.check_forecast(fc.drop("upper"), "m")


def test_last_known_is_the_end_of_val(spark):
    p = preprocess(panel(spark, {"A": walk(300)}))
    got = forecast.last_known(p.scaled).first()
    val = p.features.where("split = 'val'").orderBy(F.col("date").desc()).first()
    assert (got.last_known_date, got.last_known_price) == (val.date, pytest.approx(val.close, abs=0.005))
