"""Error metrics, the last-value baseline and the benchmark table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.numeric import cents, exact_round, pct_change
from barline.functions.text import COLUMN_NAMES, fixed, model_name, percent, signed_percent, vs_naive
from barline.schema import REPORT_ORDER, SERIES, by_date, by_series

METRICS = ["rmse", "mape", "mae"]


def error_metrics(pairs: DataFrame, keys=(SERIES, "model")) -> DataFrame:
    """RMSE, MAPE in percent over non-zero actuals (NULL without any) and MAE of (actual, predicted)."""
    a, p = F.col("actual"), F.col("predicted")
    return pairs.groupBy(*keys).agg(
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        (F.avg(F.abs(F.try_divide(a - p, a))) * 100).alias("mape"),
        F.avg(F.abs(a - p)).alias("mae"),
    )


def naive_forecast(test: DataFrame, value: str = "raw_close") -> DataFrame:
    """Each test row predicted by the row before it; the first predicts itself."""
    previous = F.lag(value).over(by_date())
    return test.where(F.col("split") == "test").select(
        SERIES, "date", F.col(value).alias("actual"), F.coalesce(previous, F.col(value)).alias("predicted")
    )


def naive_metrics(test: DataFrame, value: str = "raw_close") -> DataFrame:
    pairs = naive_forecast(test, value).withColumn("model", F.lit("naive"))
    return error_metrics(pairs)


def steps_of_test(scaled: DataFrame) -> DataFrame:
    """Test rows with their one-based step and the actual price."""
    return scaled.where(F.col("split") == "test").select(
        SERIES, F.row_number().over(by_date()).alias("step"), F.col("raw_close").alias("actual")
    )


def align_forecast_actual(forecast: DataFrame, test: DataFrame) -> DataFrame:
    """Forecast step i against the i-th test row, by position and not by date."""
    return forecast.join(steps_of_test(test), [SERIES, "step"]).select(
        SERIES, "model", "step", "actual", F.col("forecast").alias("predicted")
    )


def evaluate_models(forecast: DataFrame, test: DataFrame) -> DataFrame:
    """Metrics of every model over the whole test split, in price units."""
    return error_metrics(align_forecast_actual(forecast, test))


def attach_naive(metrics: DataFrame) -> DataFrame:
    """Baseline RMSE of the series on each of its rows."""
    baseline = F.max(F.when(F.col("model") == "naive", F.col("rmse"))).over(by_series())
    return metrics.withColumn("naive_rmse", baseline)


def benchmark_union(naive: DataFrame, models: DataFrame) -> DataFrame:
    """Baseline rows and model rows in one table."""
    return naive.select(SERIES, "model", *METRICS).unionByName(models.select(SERIES, "model", *METRICS))


def benchmark_table(models: DataFrame, naive: DataFrame) -> DataFrame:
    """Baseline rows and model rows with the RMSE change against the baseline; rounded for the report."""
    change = F.when(F.col("model") == "naive", 0.0).otherwise(pct_change(F.col("rmse"), F.col("naive_rmse")))
    return (
        attach_naive(benchmark_union(naive, models))
        .where(F.col("naive_rmse").isNotNull())
        .select(
            SERIES, "model", *[exact_round(F.col(m), 4).alias(m) for m in METRICS],
            exact_round(change, 2).alias("rmse_vs_naive_pct"),
        )
    )


def model_averages(bench: DataFrame) -> DataFrame:
    """Mean metrics and mean change per model, baseline excluded."""
    return (
        bench.where(F.col("model") != "naive")
        .groupBy("model")
        .agg(*[F.bround(F.avg(m), 4).alias(m) for m in [*METRICS, "rmse_vs_naive_pct"]])
    )


def _per_model(bench: DataFrame) -> DataFrame:
    """One row per model: sums, counts and means; everything later works on these few rows."""
    return bench.groupBy("model").agg(
        *[F.avg(m).alias(m) for m in METRICS],
        F.sum("rmse_vs_naive_pct").alias("pct_sum"),
        F.count("rmse_vs_naive_pct").alias("pct_n"),
    )


def _best(metric: str):
    """Model with the smallest mean; a tie goes to the alphabetically first name."""
    is_model = (F.col("model") != "naive") & F.col(metric).isNotNull()
    return F.min_by(F.when(is_model, F.col("model")), F.when(is_model, F.struct(metric, "model")))


def _average_change():
    """Mean change over all model rows, from the sums and counts per model."""
    is_model = F.col("model") != "naive"
    return F.try_divide(F.sum(F.when(is_model, F.col("pct_sum"))), F.sum(F.when(is_model, F.col("pct_n"))))


def best_model(bench: DataFrame, metric: str = "rmse") -> DataFrame:
    """One row with the model of the smallest mean; NULL when the benchmark holds no model."""
    return _per_model(bench).agg(_best(metric).alias("model"))


def aggregate_summary(bench: DataFrame) -> DataFrame:
    """One row over the whole benchmark; no row when it holds no model."""
    is_model = F.col("model") != "naive"
    averages = F.map_from_entries(F.sort_array(F.collect_list(
        F.when(is_model, F.struct("model", F.struct(*[F.bround(m, 4).alias(m) for m in METRICS])))
    )))
    over_models = _per_model(bench).agg(
        exact_round(_average_change(), 2).alias("avg_rmse_reduction_pct"),
        _best("rmse").alias("best_model_by_rmse"),
        _best("mape").alias("best_model_by_mape"),
        F.bround(F.max(F.when(~is_model, F.col("rmse"))), 4).alias("naive_avg_rmse"),
        averages.alias("model_avg_metrics"),
        F.count_if(is_model).alias("n_models"),
    ).where(F.col("n_models") > 0)
    return over_models.crossJoin(bench.agg(F.countDistinct(SERIES).alias("n_series")))


def kpi_summary(bench: DataFrame) -> DataFrame:
    """Headline row: average change, best model by display name, number of series."""
    headline = _per_model(bench).agg(_average_change().alias("pct"), _best("rmse").alias("best"))
    return headline.where(F.col("best").isNotNull()).crossJoin(
        bench.agg(F.countDistinct(SERIES).alias("n_series"))
    ).select(
        signed_percent(F.col("pct")).alias("avg_rmse_reduction"),
        model_name(F.col("best")).alias("best_model"),
        "n_series",
    )


def pivot_metric(bench: DataFrame, metric: str = "rmse", order: list[str] = REPORT_ORDER) -> DataFrame:
    """One metric per series, a column per model in report order."""
    return bench.groupBy(SERIES).pivot("model", order).agg(F.first(metric))


def filter_series(df: DataFrame, series: str) -> DataFrame:
    return df.where(F.col(SERIES) == series)


def filter_series_or_all(df: DataFrame, series: str | None) -> DataFrame:
    """Rows of one series; all rows when it is not given or unknown.

    Whether it is known is looked up first, by a read that stops at one row; the filter then reaches the scan.
    """
    if series is None:
        return df
    one = filter_series(df, series)
    return df if one.isEmpty() else one


def ordered_report(
    bench: DataFrame, universe: DataFrame | None = None, models: list[str] = REPORT_ORDER
) -> DataFrame:
    """Report rows: series order, then models in report order; the best model is marked once."""
    if universe is not None:
        rows = bench.join(universe.select(SERIES, "ordinal"), SERIES)
        order = F.col("ordinal")
    else:
        rows, order = bench, F.col(SERIES)
    first = rows.agg(F.min_by(SERIES, order).alias("_first"))
    mark = (F.col("model") != "naive") & (F.col("model") == F.col("_best")) & (F.col(SERIES) == F.col("_first"))
    rank = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    return (
        rows.crossJoin(first).crossJoin(best_model(bench).select(F.col("model").alias("_best")))
        .select(
            SERIES, "model", *METRICS,
            F.when(F.col("model") == "naive", "baseline")
            .otherwise(signed_percent(F.col("rmse_vs_naive_pct"))).alias("vs_naive"),
            F.when(mark, "best").otherwise("").alias("marker"),
            order.alias("_order"), rank.alias("_rank"),
        )
        .orderBy("_order", "_rank")
        .drop("_order", "_rank")
    )


def format_benchmark(bench: DataFrame, series: str | None = None) -> DataFrame:
    """Benchmark as display text under display names."""
    shown = filter_series_or_all(bench, series).select(
        SERIES,
        model_name(F.col("model")).alias("model"),
        fixed(F.col("rmse"), 4).alias("rmse"),
        percent(F.col("mape"), 2).alias("mape"),
        fixed(F.col("mae"), 4).alias("mae"),
        vs_naive(F.col("rmse_vs_naive_pct")).alias("rmse_vs_naive_pct"),
    )
    return shown.withColumnsRenamed(COLUMN_NAMES)


def round_prices(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: cents(F.col(c)) for c in columns})
