"""From model parameters to published forecasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.dates import nth_business_day, utc_stamp
from barline.functions.numeric import cents
from barline.operators.metrics import round_prices
from barline.operators.registry import get
from barline.operators.split import inverse_scale
from barline.schema import CONFIDENCE, DATE, FORECAST_META, HORIZON, MODELS, SERIES

BANDS = ["forecast", "lower", "upper"]


def check_request(horizon: int) -> None:
    if horizon < 1:
        raise ValueError(f"the horizon must be at least 1, got {horizon}")


def check_forecast(df: DataFrame, model: str) -> DataFrame:
    """A forecaster must return point, lower and upper."""
    absent = [c for c in BANDS if c not in df.columns]
    if absent:
        raise ValueError(f"the forecast of {model} lacks {', '.join(absent)}")
    return df


def last_known(scaled: DataFrame, origin: str = "val_end") -> DataFrame:
    """Anchor of each series: last date before the forecast and its unscaled close."""
    rows = scaled if origin == "last" else scaled.where(F.col("split") == "val")
    return rows.groupBy(SERIES).agg(
        F.max(DATE).alias("last_known_date"),
        cents(F.max_by("raw_close", DATE)).alias("last_known_price"),
    )


def clamp_bands(fc: DataFrame) -> DataFrame:
    """Lower not above and upper not below the point forecast."""
    return fc.withColumns({
        "lower": F.least("lower", "forecast"),
        "upper": F.greatest("upper", "forecast"),
    })


def band_check(fc: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Per (series, model): do the bands enclose the forecast on every step?"""
    inside = (F.col("lower") <= F.col("forecast") + tolerance) & (F.col("forecast") <= F.col("upper") + tolerance)
    return fc.groupBy(SERIES, "model").agg(
        F.count("*").alias("n_steps"), F.bool_and(F.coalesce(inside, F.lit(False))).alias("ok")
    )


def in_prices(fc: DataFrame, model: str, scaler: DataFrame, columns: list[str]) -> DataFrame:
    """Forecast columns in price units."""
    return inverse_scale(fc, scaler, columns) if get(model).scaled else fc


def combine_forecasts(parts: list[DataFrame]) -> DataFrame:
    """Stack forecasts; a column missing in one part becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def forecast_long(
    params: DataFrame, scaled: DataFrame, scaler: DataFrame, models: list[str] = MODELS,
    horizon: int = HORIZON, confidence: float = CONFIDENCE, origin: str = "val_end",
) -> DataFrame:
    """All models of all series: (series, model, step, date, forecast, lower, upper), rounded to cents."""
    check_request(horizon)
    parts = []
    for name in models:
        fc = get(name).forecast(params.where(F.col("model") == name), horizon, confidence)
        fc = check_forecast(fc, name).select(SERIES, "model", "step", *BANDS)
        parts.append(in_prices(fc, name, scaler, BANDS))
    anchors = last_known(scaled, origin).select(SERIES, "last_known_date")
    if origin == "last":  # parameters that end earlier would give their path other dates
        ends = params.groupBy(SERIES).agg(F.min("fit_end").alias("fit_end"))
        other = F.raise_error(F.lit("the parameters were not fitted up to the last bar")).cast("date")
        anchors = anchors.join(ends, SERIES).select(
            SERIES, F.when(F.col("fit_end") == F.col("last_known_date"), F.col("last_known_date")).otherwise(other).alias("last_known_date"))
    dated = clamp_bands(combine_forecasts(parts)).join(anchors, SERIES).select(
        SERIES, "model", "step",
        nth_business_day(F.col("last_known_date"), F.col("step")).alias(DATE),
        *BANDS,
    )
    return round_prices(dated, BANDS)


def assemble_wide(
    long: DataFrame, anchors: DataFrame, generated_at: Column, models: list[str] = MODELS
) -> DataFrame:
    """Models of a series side by side on the same dates, behind the metadata columns.

    A series whose models all failed has no row; a failed model leaves NULLs.
    """
    wide = (
        long.where(F.col("forecast").isNotNull())
        .groupBy(SERIES, DATE).pivot("model", models)
        .agg(*[F.first(c).alias(c) for c in BANDS])
    )
    return (
        wide.join(anchors, SERIES)
        .withColumn("generated_at", utc_stamp(generated_at))
        .select(
            *FORECAST_META, DATE,
            *[F.col(f"{m}_{c}") for m in models for c in BANDS],
        )
    )


def forecast_all(
    params: DataFrame, scaled: DataFrame, scaler: DataFrame, models: list[str] = MODELS,
    horizon: int = HORIZON, confidence: float = CONFIDENCE, origin: str = "val_end",
    generated_at: Column | None = None,
) -> DataFrame:
    """Wide forecast table of every series that has at least one model."""
    long = forecast_long(params, scaled, scaler, models, horizon, confidence, origin)
    stamp = generated_at if generated_at is not None else F.current_timestamp()
    return assemble_wide(long, last_known(scaled, origin), stamp, models)


def forecast_test(
    params: DataFrame, scaled: DataFrame, scaler: DataFrame, models: list[str] = MODELS
) -> DataFrame:
    """Point forecasts over the whole test split of each series, in price units."""
    sizes = scaled.groupBy(SERIES).agg(F.count_if(F.col("split") == "test").cast("int").alias("n_test"))
    shared = params.where(F.col(SERIES).isNull()).withColumn("n_test", F.lit(None).cast("int"))
    asked = params.join(sizes.where("n_test > 0"), SERIES).unionByName(shared)
    parts = []
    for name in models:
        fc = get(name).point(asked.where(F.col("model") == name), F.col("n_test"))
        parts.append(in_prices(fc.select(SERIES, "model", "step", "forecast"), name, scaler, ["forecast"]))
    return combine_forecasts(parts)


def select_models(wide: DataFrame, models: list[str]) -> DataFrame:
    """Date and the columns of the chosen models; metadata and absent models are left out."""
    return wide.select(DATE, *[
        c for m in models for c in wide.columns if c in (f"{m}_forecast", f"{m}_lower", f"{m}_upper")
    ])


def history_tail(bars: DataFrame, n: int = 90) -> DataFrame:
    """Last ``n`` rows of each series."""
    newest = Window.partitionBy(SERIES).orderBy(F.col(DATE).desc())
    return bars.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= n).drop("_r")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows of each series by date."""
    oldest = Window.partitionBy(SERIES).orderBy(DATE)
    return df.withColumn("_r", F.row_number().over(oldest)).where(F.col("_r") <= n).drop("_r")


def sort_by_date(df: DataFrame) -> DataFrame:
    return df.orderBy(SERIES, DATE)
