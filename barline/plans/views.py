"""Views for a report: forecast, history, benchmark, pivot and headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.dates import last_updated
from barline.functions.text import change_class, dollars
from barline.operators.forecast import history_tail, select_models
from barline.operators.metrics import filter_series, kpi_summary, model_averages, pivot_metric
from barline.schema import DATE, HISTORY_TAIL, MODELS
from barline.sources.layout import load_series
from barline.sources.tables import read_all_forecasts, read_benchmark


def forecast_view(forecasts: DataFrame, series: str, models: list[str] = MODELS) -> DataFrame:
    """Forecast columns of one series by date, without metadata."""
    return select_models(filter_series(forecasts, series), models).orderBy(DATE)


def forecast_text(forecasts: DataFrame, series: str, models: list[str] = MODELS) -> DataFrame:
    """The forecast of one series as display text."""
    view = forecast_view(forecasts, series, models)
    return view.select(
        F.date_format(DATE, "yyyy-MM-dd").alias(DATE), *[dollars(F.col(c)).alias(c) for c in view.columns if c != DATE]
    )


def stamp_view(forecasts: DataFrame) -> DataFrame:
    return forecasts.agg(last_updated(F.col("generated_at")).alias("last_updated"))


def benchmark_view(bench: DataFrame) -> DataFrame:
    """Benchmark rows with the class of their change against the baseline."""
    return bench.withColumn("change_class", change_class(F.col("rmse_vs_naive_pct")))


def create_views(spark: SparkSession, workdir: str, fallback: str | None = None) -> list[str]:
    """Register the stored tables as temp views; returns the names of those that exist."""
    forecasts = read_all_forecasts(
        spark, f"{workdir}/all_forecasts", f"{fallback}/all_forecasts" if fallback else None
    )
    bench = read_benchmark(spark, f"{workdir}/benchmark")
    bars = load_series(spark, f"{workdir}/bars")
    views: dict[str, DataFrame] = {}
    if forecasts is not None:
        views["v_forecast"] = forecasts
        views["v_last_updated"] = stamp_view(forecasts)
    if bars is not None:
        views["v_history_tail"] = history_tail(bars, HISTORY_TAIL)
    if bench is not None:
        views["v_benchmark"] = benchmark_view(bench)
        views["v_benchmark_pivot"] = pivot_metric(bench)
        views["v_kpi"] = kpi_summary(bench)
        views["v_model_averages"] = model_averages(bench)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
