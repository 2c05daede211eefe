"""Trend and seasonality for all series at once: trend with changepoints x (1 + yearly + weekly).

Two ridge regressions per series, trend first and the seasonal ratio second; each is one Gram pass and
a batched solve.  Prices are fitted unscaled, because a multiplicative season does not commute with
min-max scaling.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.dates import nth_business_day
from barline.functions.numeric import array_dot, ratio, z_value
from barline.operators.linear import gram_sums, solve, unpack
from barline.operators.split import train_plus_val
from barline.schema import CHANGEPOINT_PRIOR, CONFIDENCE, DATE, HORIZON, SEASONALITY_PRIOR, SERIES, by_series
from barline.sources.layout import cut_lineage

# Layout of the published additive-regression form (Taylor and Letham 2018).
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_ORDER, YEARLY_DAYS = 10, 365.25
WEEKLY_ORDER, WEEKLY_DAYS = 3, 7.0



def to_ds_y(df: DataFrame, value: str = "close") -> DataFrame:
    """Time and target under the names ``ds`` (time zone removed) and ``y``."""
    return df.select(SERIES, F.col(DATE).cast("timestamp_ntz").alias("ds"), F.col(value).alias("y"))


def hinges(t: Column) -> Column:
    """Array of 1, t and ``max(t - c, 0)`` at changepoints spread over the first part of the span."""
    spots = F.transform(
        F.sequence(F.lit(1), F.lit(N_CHANGEPOINTS)),
        lambda i: F.greatest(t - i * (CHANGEPOINT_RANGE / N_CHANGEPOINTS), F.lit(0.0)),
    )
    return F.concat(F.array(F.lit(1.0), t), spots)


def seasonal(day: Column) -> Column:
    """Array of the yearly and weekly sine and cosine terms of a date."""
    days = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("double")

    def waves(wave, order: int, period: float) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(order)), lambda k: wave(days * k * (2 * math.pi / period)))

    return F.concat(*[
        waves(wave, order, period)
        for order, period in ((YEARLY_ORDER, YEARLY_DAYS), (WEEKLY_ORDER, WEEKLY_DAYS))
        for wave in (F.sin, F.cos)
    ])


N_TREND = N_CHANGEPOINTS + 2
N_SEASON = 2 * (YEARLY_ORDER + WEEKLY_ORDER)


def _elapsed(day: Column, start: Column, end: Column) -> Column:
    """Time scaled to 0..1 over the fitted span."""
    return ratio(F.datediff(day, start).cast("double"), F.datediff(end, start).cast("double"))


def _ridge(n_x: int, free: int, prior: float, with_const: bool):
    """Scalar Pandas UDF: Gram array to ridge coefficients followed by the residual deviation.

    The penalty is residual variance over prior variance, the posterior mode under normal priors; the
    first ``free`` coefficients carry none.  The residual variance is that of a fit without prior.
    """
    lead = 0 if with_const else 1

    @F.pandas_udf("array<double>")
    def fitted(gram: pd.Series) -> pd.Series:
        g = unpack(gram, n_x + 2)
        n = np.maximum(g[:, 0, 0], 1.0)
        a, b, yy = g[:, lead:-1, lead:-1], g[:, lead:-1, -1], g[:, -1, -1]
        penalised = np.r_[np.zeros(free), np.ones(a.shape[1] - free)]

        def deviation(w):
            rss = yy - 2 * (w * b).sum(1) + np.einsum("ni,nij,nj->n", w, a, w)
            return np.sqrt(np.maximum(rss, 0.0) / n)

        least = 1e-7 * n  # keeps the system regular when a term never varies, as a weekday without rows
        rough, _ = solve(a + np.eye(a.shape[1]) * least[:, None, None], b)
        rough = np.where(np.isfinite(rough), rough, 0.0)
        strength = np.maximum(deviation(rough) ** 2 / prior**2, least)
        coef, ok = solve(a + np.eye(a.shape[1]) * (penalised * strength[:, None])[:, None, :], b)
        out = np.column_stack([coef, deviation(np.where(ok[:, None], coef, 0.0))])
        return pd.Series([list(r) if o else None for r, o in zip(out, ok)])

    return fitted


def fit_decomposition(scaled: DataFrame, origin: str = "val_end", value: str = "raw_close") -> DataFrame:
    """Fit on train + val of the raw close.  Returns model parameter rows."""
    history = scaled if origin == "last" else train_plus_val(scaled)
    whole = by_series()
    rows = history.select(
        SERIES, DATE, F.col(value).alias("price"),
        F.min(DATE).over(whole).alias("fit_start"),
        F.max(DATE).over(whole).alias("fit_end"),
        F.max(F.abs(value)).over(whole).alias("unit"),
    ).withColumns({
        "t": _elapsed(F.col(DATE), F.col("fit_start"), F.col("fit_end")),
        "y": ratio(F.col("price"), F.col("unit")),
    })
    t = F.col("t")
    trend = cut_lineage(gram_sums(rows, F.slice(hinges(t), 2, N_TREND - 1), F.col("y")).select(
        SERIES, _ridge(N_TREND - 1, 2, CHANGEPOINT_PRIOR, True)("gram").alias("trend")
    ))
    level = array_dot(F.slice("trend", 1, N_TREND), hinges(t))
    detrended = rows.join(trend.where("trend is not null"), SERIES).withColumn("r", ratio(F.col("y"), level) - 1.0)
    season = gram_sums(detrended, seasonal(F.col(DATE)), F.col("r")).select(
        SERIES, _ridge(N_SEASON, 0, SEASONALITY_PRIOR, False)("gram").alias("season")
    )
    span = rows.groupBy(SERIES).agg(*[F.first(c).alias(c) for c in ("fit_start", "fit_end", "unit")])
    ok = F.col("trend").isNotNull() & F.col("season").isNotNull()
    start = F.datediff("fit_start", F.lit("1970-01-01").cast("date")).cast("double")
    return (
        span.join(trend, SERIES, "left").join(season, SERIES, "left")
        .select(
            SERIES,
            F.lit("prophet").alias("model"),
            "fit_end",
            F.when(ok, F.create_map(
                F.lit("trend"), F.slice("trend", 1, N_TREND),
                F.lit("season"), F.slice("season", 1, N_SEASON),
                F.lit("sigma"), F.array(F.element_at("season", -1)),
                F.lit("start"), F.array(start),
                F.lit("unit"), F.array(F.col("unit")),
                F.lit("width"), F.array(F.lit(CONFIDENCE)),
            )).alias("params"),
            F.when(~ok, "singular or too few rows").alias("error"),
        )
    )


def width_mismatch(confidence: float, fitted: float = CONFIDENCE) -> bool:
    """Is the requested confidence not the fitted one?  Then the fitted width is used."""
    return abs(confidence - fitted) > 0.01


def decomposition_interval(paths: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """Band of the residual deviation at the fitted width; ``width_mismatch`` marks another request."""
    half = F.abs(F.col("level")) * F.col("sigma") * z_value(CONFIDENCE)
    return paths.select(
        SERIES, "model", "step", "forecast",
        (F.col("forecast") - half).alias("lower"), (F.col("forecast") + half).alias("upper"),
        (F.abs(F.lit(float(confidence)) - F.col("width")) > 0.01).alias("width_mismatch"),
    )


def forecast_decomposition(
    params: DataFrame, horizon: int | Column = HORIZON, confidence: float = CONFIDENCE
) -> DataFrame:
    """Price forecast on the business days after the fit, with its band."""
    h = horizon if isinstance(horizon, Column) else F.lit(horizon)
    p = F.col("params")
    fit_start = F.date_add(F.lit("1970-01-01").cast("date"), p["start"][0].cast("int"))
    steps = params.where(p.isNotNull()).select(
        SERIES, "model", "fit_end", fit_start.alias("fit_start"),
        p["trend"].alias("trend"), p["season"].alias("season"),
        p["unit"][0].alias("unit"), p["sigma"][0].alias("sigma"), p["width"][0].alias("width"),
        F.explode(F.sequence(F.lit(1), h)).alias("step"),
    ).withColumn("day", nth_business_day(F.col("fit_end"), F.col("step")))
    t = _elapsed(F.col("day"), F.col("fit_start"), F.col("fit_end"))
    level = steps.withColumn("t", t).withColumns({
        "level": array_dot(F.col("trend"), hinges(F.col("t"))),
        "ratio": array_dot(F.col("season"), seasonal(F.col("day"))),
    })
    paths = level.withColumns({
        "forecast": F.col("level") * (1.0 + F.col("ratio")) * F.col("unit"),
        "level": F.col("level") * F.col("unit"),
    })
    return decomposition_interval(paths, confidence)
