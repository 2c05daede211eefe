"""Forecasters by name.  A user adds one with :func:`register`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.operators import arima, decomposition, sequence
from barline.schema import MODELS, SERIES


@dataclass(frozen=True)
class Forecaster:
    """A model as functions from tables to tables, for all series at once.

    ``fit(scaled)`` returns model parameter rows (see ``schema.MODEL_PARAMS``); one that can continue to
    another origin takes ``origin`` as well.  ``pooled`` tells that a series' parameters depend on the
    other series, so all are needed to fit one.  ``forecast(params,
    horizon, confidence)`` rows of (series, model, step, forecast, lower, upper) and ``point(params,
    horizon)`` the same without band; there the horizon is a column.  ``scaled`` tells whether the
    forecasts are in scaled units or in prices.  A pooled model may store what its series share in one row without a series;
    ``resume(scaled, origin=...)`` then gives the rows of further series under the shared row that is stored.  A library that works on one series at a time can sit
    inside ``fit`` as ``groupBy("series").applyInPandas``.
    """

    name: str
    fit: Callable[[DataFrame], DataFrame]
    forecast: Callable[..., DataFrame]
    point: Callable[..., DataFrame]
    scaled: bool = True
    pooled: bool = False
    resume: Callable[..., DataFrame] | None = None


_known = {
    "arima": Forecaster("arima", arima.fit_arima, arima.forecast_arima, arima.forecast_arima),
    "prophet": Forecaster(
        "prophet", decomposition.fit_decomposition, decomposition.forecast_decomposition,
        decomposition.forecast_decomposition, scaled=False,
    ),
    "lstm": Forecaster(
        "lstm", sequence.fit_sequence_regression, sequence.stochastic_forecast, sequence.forecast_recursive,
        pooled=True, resume=sequence.series_windows,
    ),
}


def register(forecaster: Forecaster) -> None:
    _known[forecaster.name] = forecaster


def get(name: str) -> Forecaster:
    if name not in _known:
        raise ValueError(f"unknown model {name!r}; known are {', '.join(_known)}")
    return _known[name]


def fit(name: str, scaled: DataFrame, origin: str = "val_end") -> DataFrame:
    """Parameter rows of a model, its state continued to the origin."""
    forecaster = get(name)
    return forecaster.fit(scaled) if origin == "val_end" else forecaster.fit(scaled, origin=origin)


def model_summary(params: DataFrame) -> DataFrame:
    """One line of text per fitted model; rows without a series, which models share among theirs, have none."""
    params = params.where(F.col(SERIES).isNotNull())
    p = F.col("params")
    arima_line = F.format_string(
        "ARIMA(%s): order=(%d,%d,%d), fitted to %s", F.col(SERIES),
        *[p["order"][i].cast("int") for i in range(3)], F.col("fit_end").cast("string"),
    )
    trend_line = F.format_string(
        "Trend and seasonality(%s): %d changepoints, last date %s", F.col(SERIES),
        F.size(p["trend"]) - 2, F.col("fit_end").cast("string"),
    )
    window_line = F.format_string(
        "Look-back regression(%s): features=%d, look-back=%d, coefficients=%d, fitted to %s", F.col(SERIES),
        p["shape"][1].cast("int"), p["shape"][0].cast("int"), (p["shape"][0] * p["shape"][1]).cast("int") + 1, F.col("fit_end").cast("string"),
    )
    line = (
        F.when(p.isNull(), F.format_string("%s(%s): not fitted", F.upper("model"), F.col(SERIES)))
        .when(F.col("model") == MODELS[0], arima_line)
        .when(F.col("model") == MODELS[1], trend_line)
        .when(F.col("model") == MODELS[2], window_line)
        .otherwise(F.format_string("%s(%s): fitted to %s", F.upper("model"), F.col(SERIES),
                                   F.col("fit_end").cast("string")))
    )
    return params.select(SERIES, "model", line.alias("summary"))
