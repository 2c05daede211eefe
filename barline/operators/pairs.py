"""Sets of series and of (series, model) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.schema import MODELS, SERIES, UNIVERSE


def universe_table(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """The configured series in order: (ordinal, series)."""
    rows = list(enumerate(UNIVERSE if names is None else names))
    return spark.createDataFrame(rows, "ordinal int, series string")


def distinct_series(df: DataFrame) -> DataFrame:
    return df.select(SERIES).distinct()


def available_series(forecasts: DataFrame, universe: DataFrame) -> DataFrame:
    """Series of the universe that have a forecast, in configured order."""
    return universe.join(distinct_series(forecasts), SERIES, "left_semi").orderBy("ordinal")


def failed_series(universe: DataFrame, ok: DataFrame) -> DataFrame:
    """Series of the universe that are not among the succeeded."""
    return universe.select(SERIES).subtract(ok.select(SERIES))


def all_pairs(series: DataFrame, models: list[str] = MODELS) -> DataFrame:
    """Every series with every requested model; the models are an array literal, so nothing is joined."""
    return series.select(SERIES, F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))


def attach_models(pairs: DataFrame, params: DataFrame) -> DataFrame:
    """Requested pairs with their fitted parameters and a status: ok, failed or missing."""
    fitted = params.select(SERIES, "model", "fit_end", "params", "error", F.lit(True).alias("_seen"))
    status = (
        F.when(F.col("_seen").isNull(), "missing").when(F.col("params").isNull(), "failed").otherwise("ok")
    )
    return pairs.join(fitted, [SERIES, "model"], "left").withColumn("status", status).drop("_seen")


def fitted_guard(pairs: DataFrame, params: DataFrame) -> DataFrame:
    """Requested pairs that cannot be forecast, with the reason."""
    return (
        attach_models(pairs, params)
        .where(F.col("status") != "ok")
        .select(SERIES, "model", F.coalesce("error", F.lit("not fitted")).alias("error"))
    )


def params_of(params: DataFrame, wanted: DataFrame) -> DataFrame:
    """Parameter rows of the wanted series, or pairs, and the rows without a series that models share among theirs."""
    on = [c for c in (SERIES, "model") if c in wanted.columns]
    return params.join(wanted, on, "left_semi").unionByName(params.where(F.col(SERIES).isNull()))


def untrained_pairs(params: DataFrame, pairs: DataFrame) -> DataFrame:
    """Requested pairs without fitted parameters."""
    fitted = params.where(F.col("params").isNotNull())
    return pairs.join(fitted.select(SERIES, "model"), [SERIES, "model"], "left_anti")


def benchmarkable_series(params: DataFrame, scaled: DataFrame) -> DataFrame:
    """Series that were trained and have test rows."""
    tested = scaled.where(F.col("split") == "test").select(SERIES)
    return distinct_series(params).join(tested, SERIES, "left_semi")
