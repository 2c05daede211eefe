"""Forecast, benchmark, report and parameter tables, and their publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.metrics import METRICS, aggregate_summary
from barline.schema import BENCHMARK, SERIES
from barline.sources.layout import BUCKETS, load_series, read_or_none, save_series

# Published tables: those laid out by series, and plain ones with their format.
BY_SERIES = {"bars": (), "features": (), "scaler": (), "scaled": (), "forecasts": (), "model_params": ("model",)}
PLAIN = {"all_forecasts": "parquet", "benchmark": "csv", "benchmark_summary": "json",
         "training_report": "json", "training_totals": "json", "rejected": "parquet", "run_summary": "json"}
CSV_OPTIONS = {"header": True}


def write_forecasts(wide: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store the forecasts of the given series; those of other series stay."""
    save_series(wide, path, buckets=buckets)


def write_all_forecasts(wide: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The combined forecast table, metadata columns first; ``csv`` for other tools."""
    wide.write.mode("overwrite").options(**(CSV_OPTIONS if fmt == "csv" else {})).format(fmt).save(path)


def read_forecast(spark: SparkSession, path: str, series: str) -> DataFrame | None:
    """Forecast of one series; None without a table, no row for an unknown series."""
    return load_series(spark, path, [series])


def read_all_forecasts(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame | None:
    """The combined table, from the fallback path when the first holds none."""
    table = read_or_none(spark, path)
    if table is None and fallback is not None:
        table = read_or_none(spark, fallback)
    return table


def write_benchmark(bench: DataFrame, path: str, summary_path: str) -> None:
    """Benchmark as CSV under the published header and, from the stored rows, its summary as JSON."""
    bench.select(
        F.col(SERIES).alias("ticker"), "model", *[F.col(m).alias(m.upper()) for m in METRICS], "rmse_vs_naive_pct"
    ).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    aggregate_summary(read_benchmark(bench.sparkSession, path)).write.mode("overwrite").json(summary_path)


def read_benchmark(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored benchmark; None when the file or one of its columns is missing."""
    raw = read_or_none(spark, path, "csv", **CSV_OPTIONS)
    if raw is None or not set(BENCHMARK.names) <= set(raw.columns):
        return None
    typed = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name.lower()) for f in BENCHMARK])
    return typed.withColumnRenamed("ticker", SERIES)


def training_totals(report: DataFrame) -> DataFrame:
    """One row over a training report: pairs, successes, failures, seconds."""
    return report.agg(
        F.count("*").alias("total"),
        F.count_if("success").alias("success"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("seconds"),
    )


def series_totals(report: DataFrame) -> DataFrame:
    """Successes and failures per series, with the failed models."""
    return report.groupBy(SERIES).agg(
        F.count_if("success").alias("success"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sort_array(F.collect_list(F.when(~F.col("success"), F.col("model")))).alias("failed_models"),
    )


def write_training_report(report: DataFrame, path: str, totals_path: str) -> None:
    """One JSON record per (series, model), and the totals as a table of their own.

    Folding all records into the totals row would put the whole report into one task.
    """
    report.write.mode("overwrite").json(path)
    stored = report.sparkSession.read.schema(report.schema).json(path)
    training_totals(stored).write.mode("overwrite").json(totals_path)


def write_model_params(params: DataFrame, path: str) -> None:
    """Store parameters; a given (series, model) replaces its old row, so what a model's series share in a row without a
    series is replaced for all of them."""
    save_series(params, path, extra=("model",))


def read_model_params(
    spark: SparkSession, path: str, series: list[str] | None = None, models: list[str] | None = None
) -> DataFrame | None:
    """Stored parameters, restricted by partition pruning; missing pairs are simply absent.

    Rows without a series, which models share among the chosen series, are read with them.
    """
    table = load_series(spark, path, None if series is None else [*series, None])
    if table is not None and models is not None:
        table = table.where(F.col("model").isin(models))
    return table


def publish_tables(
    spark: SparkSession, src: str, dst: str, tables: list[str] | None = None,
    series: list[str] | None = None, models: list[str] | None = None,
) -> DataFrame:
    """Copy stored tables from one root to another and report each: (table, status, error).

    The scheme of the root selects the store, and swapping the roots restores.  A table that is absent
    is skipped; one that fails leaves the others.
    """
    results = []
    for name in tables or [*BY_SERIES, *PLAIN]:
        try:
            if name in BY_SERIES:
                shared = [None] if name == "model_params" else []  # what the series of a model have in common
                rows = load_series(spark, f"{src}/{name}", None if series is None else [*series, *shared])
                if rows is not None and models is not None and "model" in rows.columns:
                    rows = rows.where(F.col("model").isin(models))
                if rows is not None:
                    save_series(rows, f"{dst}/{name}", BY_SERIES[name])
            else:
                options = CSV_OPTIONS if PLAIN[name] == "csv" else {}
                rows = read_or_none(spark, f"{src}/{name}", PLAIN[name], **options)
                if rows is not None:
                    key = next((c for c in (SERIES, "ticker") if c in rows.columns), None)
                    if series is not None and key:
                        rows = rows.where(F.col(key).isin(series))
                    rows.write.mode("overwrite").options(**options).format(PLAIN[name]).save(f"{dst}/{name}")
            results.append((name, "absent" if rows is None else "copied", None))
        except Exception as problem:  # one table that cannot be copied must not stop the others
            results.append((name, "failed", str(problem).splitlines()[0]))
    return spark.createDataFrame(results, "table string, status string, error string")


def publish_outcome(results: DataFrame) -> DataFrame:
    """One row: tables copied and failed; complete without a failure, usable with one copy."""
    copied, failed = F.count_if(F.col("status") == "copied"), F.count_if(F.col("status") == "failed")
    return results.agg(
        copied.alias("copied"), failed.alias("failed"),
        (failed == 0).alias("complete"), (copied > 0).alias("usable"),
    )


def artifact_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Stored files under a root: table, path, bytes, time.  File contents are not read."""
    files = read_or_none(spark, path, "binaryFile", recursiveFileLookup=True)
    if files is None:
        return spark.createDataFrame(
            [], "table string, path string, length bigint, modificationTime timestamp"
        )
    root = "/" + path.split("://")[-1].strip("/") + "/"
    table = F.substring_index(F.substring_index("path", root, -1), "/", 1)
    return files.select(table.alias("table"), "path", "length", "modificationTime")


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Files and bytes per table."""
    return manifest.groupBy("table").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))

