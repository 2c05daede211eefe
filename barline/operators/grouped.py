"""A forecaster from two plain functions that see one series at a time.

For models that exist as a library call per series.  Spark groups the rows and holds one series a
task (a row per day), batches of parameters are forecast without a shuffle.  What a function raises,
or returns in a form that is not asked for, becomes the error of that series; the others go on.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.registry import Forecaster
from barline.operators.split import train_plus_val
from barline.schema import CONFIDENCE, DATE, FEATURES, HORIZON, MODEL_PARAMS, SERIES, by_series

PATHS = f"{SERIES} string, model string, step int, forecast double, lower double, upper double"
STEP_ROWS = 1 << 16  # rows that a task holds before it sends them on
MESSAGE = 500  # characters of an error


def _parameters(found) -> dict[str, list[float]]:
    """The parameters as lists of finite numbers, or an error that names the first one that is not."""
    if not isinstance(found, dict) or not found:
        raise TypeError(f"fit must return a dict that is not empty, got {type(found).__name__}")
    out = {}
    for name, value in found.items():
        values = np.atleast_1d(np.asarray(value, dtype=float))
        if not isinstance(name, str) or values.ndim != 1 or not np.isfinite(values).all():
            raise ValueError(f"parameter {name!r} is no list of finite numbers")
        out[name] = values.tolist()
    return out


def _band(path, steps: int) -> np.ndarray:
    """(steps, 3): forecast, lower and upper; a path without band is its own."""
    path = np.asarray(path, dtype=float)
    if path.shape == (steps,):
        path = np.repeat(path[:, None], 3, axis=1)
    if path.shape != (steps, 3):
        raise ValueError(f"predict must return {steps} values or rows of three, got shape {path.shape}")
    return np.where(np.isfinite(path), path, np.nan)


def _message(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:MESSAGE]


def grouped(
    name: str, fit: Callable[[pd.DataFrame], dict], predict: Callable[..., np.ndarray], cols: list[str] = FEATURES, scaled: bool = True,
) -> Forecaster:
    """A :class:`Forecaster` to be registered.

    ``fit(frame)`` gets the rows of a series up to the origin in date order (series, date, split and ``cols``)
    and returns numbers or lists of numbers by name.  ``predict(params, horizon, confidence)`` returns the
    path, or rows of (forecast, lower, upper).  It is tried for one step when the series is fitted, so one that
    cannot work is an error row then; where it fails later, its steps have NULL values.
    """
    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(DATE, kind="stable").reset_index(drop=True)
        params = error = None
        try:
            params = _parameters(fit(frame.drop(columns=["fit_end"])))
            _band(predict(params, 1, CONFIDENCE), 1)
        except Exception as e:  # noqa: BLE001 - whatever a user's model raises belongs to its series
            params, error = None, _message(e)
        return pd.DataFrame({SERIES: [frame[SERIES][0]], "model": [name], "fit_end": [frame["fit_end"][0]], "params": [params], "error": [error]})

    def fit_all(rows: DataFrame, origin: str = "val_end") -> DataFrame:
        history = rows if origin == "last" else train_plus_val(rows)
        history = history.select(SERIES, DATE, "split", *cols).withColumn("fit_end", F.max(DATE).over(by_series()))
        return history.groupBy(SERIES).applyInPandas(fitted, MODEL_PARAMS)

    def forecast(params: DataFrame, horizon: int | Column = HORIZON, confidence: float = CONFIDENCE) -> DataFrame:
        def paths(batches):
            held, rows = [], 0
            for batch in batches:
                for series, model, known, steps in zip(batch[SERIES], batch["model"], batch["params"], batch["h"]):
                    try:
                        path = _band(predict({k: list(v) for k, v in dict(known).items()}, int(steps), confidence), int(steps))
                    except Exception:  # noqa: BLE001
                        path = np.full((int(steps), 3), np.nan)
                    held.append(pd.DataFrame({SERIES: series, "model": model, "step": np.arange(1, int(steps) + 1, dtype="int32"),
                                              "forecast": path[:, 0], "lower": path[:, 1], "upper": path[:, 2]}))
                    rows += int(steps)
                    if rows >= STEP_ROWS:
                        yield pd.concat(held, ignore_index=True)
                        held, rows = [], 0
            if held:
                yield pd.concat(held, ignore_index=True)

        h = horizon if isinstance(horizon, Column) else F.lit(horizon)
        asked = params.where(F.col("params").isNotNull()).select(SERIES, "model", "params", h.cast("int").alias("h")).where("h > 0")
        out = asked.mapInPandas(paths, PATHS)
        return out.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("forecast", "lower", "upper")})

    return Forecaster(name, fit_all, forecast, forecast, scaled=scaled)
