"""Training, benchmark and their reports."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.operators.forecast import forecast_test
from barline.operators.metrics import aggregate_summary, benchmark_table, evaluate_models, naive_metrics
from barline.operators.pairs import all_pairs, attach_models, benchmarkable_series, distinct_series, params_of, untrained_pairs
from barline.operators.registry import fit, get
from barline.schema import MODEL_PARAMS, MODELS, SERIES
from barline.sources.tables import read_benchmark, read_model_params, write_benchmark, write_model_params


def fit_models(scaled: DataFrame, models: list[str] = MODELS, origin: str = "val_end") -> DataFrame:
    """Parameter rows of every (series, model), one job per model over all series."""
    parts = [fit(m, scaled, origin).select(*MODEL_PARAMS.names) for m in models]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def train_all(
    scaled: DataFrame, path: str, models: list[str] = MODELS, overwrite: bool = True, origin: str = "val_end",
) -> tuple[DataFrame, DataFrame]:
    """Fit and store every (series, model); returns the parameters of these pairs and the training report.

    Without ``overwrite`` only the pairs that have no stored parameters are fitted.  A pooled model then goes on with what it has
    stored for all series, and sees all series again only where it has stored nothing of the kind.  A series that cannot be fitted carries its error; a model whose whole job
    fails is reported as failed for its series, does not stop the others, and has no parameters in the
    result, whatever an earlier run stored.
    """
    spark = scaled.sparkSession
    for m in models:
        get(m)
    seconds, problems = {}, {}
    pairs = all_pairs(distinct_series(scaled), models)
    stored = read_model_params(spark, path)
    for m in models:
        started = time.time()
        try:
            missing = None
            if not overwrite and stored is not None:
                missing = untrained_pairs(stored, pairs.where(F.col("model") == m)).select(SERIES)
                if missing.isEmpty():
                    seconds[m] = 0.0
                    continue
            resume = None
            if missing is not None and get(m).resume and not stored.where(
                    F.col(SERIES).isNull() & (F.col("model") == m) & F.col("params").isNotNull()).isEmpty():
                resume = get(m).resume
            some = missing is not None and (resume or not get(m).pooled)
            rows = scaled.join(missing, SERIES, "left_semi") if some else scaled
            fitted = resume(rows, origin=origin) if resume else fit(m, rows, origin)
            if missing is not None:
                fitted = params_of(fitted, missing)
            write_model_params(fitted.select(*MODEL_PARAMS.names), path)
        except Exception as problem:  # whatever a forecaster raises must not stop the others
            problems[m] = str(problem).splitlines()[0]
        seconds[m] = round(time.time() - started, 2)
    params = read_model_params(spark, path, models=[m for m in models if m not in problems])
    if params is None:
        params = spark.createDataFrame([], MODEL_PARAMS)
    params = params_of(params, pairs)
    return params, training_report(pairs, params, seconds, problems, path)


def training_report(
    pairs: DataFrame, params: DataFrame, seconds: dict | None = None, problems: dict | None = None, path: str = ""
) -> DataFrame:
    """One record per requested pair: success, seconds of its model's job, error, where it is stored."""

    def by_model(values: dict, default):
        out = F.lit(default)
        for name, value in (values or {}).items():
            out = F.when(F.col("model") == name, value).otherwise(out)
        return out

    joined = attach_models(pairs, params)
    success = F.col("status") == "ok"
    job_error = by_model(problems, "")
    return joined.select(
        SERIES,
        "model",
        success.alias("success"),
        by_model(seconds, 0.0).cast("double").alias("duration_s"),
        F.when(success, "").otherwise(F.coalesce(F.col("error"), F.nullif(job_error, F.lit("")), F.col("status")))
        .alias("error"),
        F.when(success & F.lit(bool(path)), F.concat(F.lit(f"{path}/model="), F.col("model"))).otherwise("")
        .alias("saved_path"),
    )


def benchmark(params: DataFrame, scaled: DataFrame, scaler: DataFrame, models: list[str] = MODELS) -> DataFrame:
    """Baseline and model errors over the test split for every series that has both."""
    tested = scaled.join(benchmarkable_series(params, scaled), SERIES, "left_semi")
    scores = evaluate_models(forecast_test(params, scaled, scaler, models), tested)
    return benchmark_table(scores, naive_metrics(tested))


def run_benchmark(
    params: DataFrame, scaled: DataFrame, scaler: DataFrame, models: list[str] = MODELS,
    path: str | None = None, summary_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Benchmark table and summary; stored when paths are given, and then read from there."""
    table = benchmark(params, scaled, scaler, models)
    if path and summary_path:
        write_benchmark(table, path, summary_path)
        table = read_benchmark(scaled.sparkSession, path)
    return table, aggregate_summary(table)
