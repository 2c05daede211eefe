"""Look-back regression: the next close from the last 60 rows of all features.

One ridge regression is pooled over all series, whose features share the 0..1 scale.  Its Gram matrix
is summed on the executors and has a fixed size, (60 x 13 + 2) squared, whatever the data.
The regularisation is the one with the smallest validation loss, the counterpart of early stopping;
that loss follows from the Gram matrix of the validation rows, without another pass.

The coefficients are stored once, in a parameter row without a series; the row of a series holds its last window.
Series that come later take the stored coefficients and need their window only.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions.numeric import z_value
from barline.operators.linear import unpack
from barline.operators.split import train_plus_val
from barline.schema import (
    CONFIDENCE, DATE, DROPOUT, FEATURES, HORIZON, LOOK_BACK, MODEL_PARAMS, SEED, SERIES, STOCHASTIC_PASSES, TARGET, by_date,
)

MODEL = "lstm"  # its name in the registry

# Penalties per row, smallest first.
PENALTIES = [1e-4, 1e-3, 1e-2, 1e-1, 1.0]
TOO_SHORT = "train split not longer than the look-back"
BLOCK = 2000  # windows that are laid out at a time


def build_sequences(df: DataFrame, cols: list[str] = FEATURES, look_back: int = LOOK_BACK) -> DataFrame:
    """Sliding windows: ``x`` holds the ``look_back`` rows before a row, ``y`` its close.

    Windows stay inside (series, split); n - look_back rows come out of n.
    """
    frame = Window.partitionBy(SERIES, "split").orderBy(DATE).rowsBetween(-look_back, -1)
    return (
        df.select(
            SERIES, "split", DATE,
            F.collect_list(F.array(*cols)).over(frame).alias("x"),
            F.col(TARGET).alias("y"),
        )
        .where(F.size("x") == look_back)
    )


def last_sequence(df: DataFrame, cols: list[str] = FEATURES, look_back: int = LOOK_BACK, origin: str = "val_end"):
    """The final ``look_back`` rows up to the origin, oldest first, one row per series."""
    history = df if origin == "last" else train_plus_val(df)
    from_end = F.row_number().over(Window.partitionBy(SERIES).orderBy(F.col(DATE).desc()))
    ordered = F.sort_array(F.collect_list(F.struct(DATE, F.array(*cols).alias("v"))))
    return (
        history.withColumn("_r", from_end)
        .where(F.col("_r") <= look_back)
        .groupBy(SERIES)
        .agg(F.max(DATE).alias("fit_end"), ordered.alias("_rows"))
        .select(SERIES, "fit_end", F.transform("_rows", lambda r: r["v"]).alias("x"))
    )


def sequence_length_guard(scaled: DataFrame, look_back: int = LOOK_BACK) -> DataFrame:
    """Per series: train rows, and an error when they are not more than the look-back."""
    return scaled.groupBy(SERIES).agg(F.count_if(F.col("split") == "train").alias("n_train")).withColumn(
        "too_short", F.when(F.col("n_train") <= look_back, TOO_SHORT)
    )


def _window_sums(k: int, look_back: int, target: int):
    """mapInPandas helper: Gram matrices of the sliding windows in rows sorted by (series, date).

    Only the plain rows travel to Python; their windows exist for one block at a time.  The last rows of
    a batch are carried into the next one, so a series is never held whole.
    """
    width = look_back * k + 2
    upper = np.triu_indices(width)

    def sums(batches):
        totals = {}
        key, tail = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            series, splits = pdf["series"].to_numpy(), pdf["split"].to_numpy()
            values = pdf[[f"x{i}" for i in range(k)]].to_numpy(dtype=float)
            changes = np.flatnonzero((series[1:] != series[:-1]) | (splits[1:] != splits[:-1])) + 1
            edges = [0, *changes.tolist(), len(series)]
            for a, b in zip(edges[:-1], edges[1:]):
                rows = values[a:b] if (series[a], splits[a]) != key else np.vstack([tail, values[a:b]])
                key, tail = (series[a], splits[a]), rows[-look_back:]
                for at in range(0, len(rows) - look_back, BLOCK):
                    part = rows[at:at + BLOCK + look_back]
                    windows = np.lib.stride_tricks.sliding_window_view(part[:-1], look_back, axis=0)
                    x = windows.transpose(0, 2, 1).reshape(len(windows), -1)
                    step = part[look_back:, target] - part[look_back - 1:-1, target]
                    full = np.column_stack([np.ones(len(x)), x, step])
                    totals[key[1]] = totals.get(key[1], 0.0) + full.T @ full
        for split, total in totals.items():
            yield pd.DataFrame({"split": [split], "part": [total[upper]]})

    return sums


def _grams(scaled: DataFrame, cols: list[str], look_back: int) -> dict[str, np.ndarray]:
    """Gram matrices of (1, window, step) over the train and the val rows, in one pass.

    Every task sends one matrix per split; they are added in two rounds over the square root of the
    tasks, so no task receives them all.
    """
    rounds = math.isqrt(int(scaled.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    width = look_back * len(cols) + 2
    rows = scaled.where(F.col("split") != "test").select(
        SERIES, "split", F.row_number().over(by_date()).alias("k"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(cols)]
    )
    parts = rows.mapInPandas(
        _window_sums(len(cols), look_back, cols.index(TARGET)), "split string, part array<double>"
    ).select("split", (F.spark_partition_id() % rounds).alias("slot"), array_to_vector("part").alias("part"))
    first = parts.groupBy("split", "slot").agg(Summarizer.sum(F.col("part")).alias("part"))
    total = first.groupBy("split").agg(vector_to_array(Summarizer.sum(F.col("part"))).alias("part"))
    return {r["split"]: unpack([r["part"]], width)[0] for r in total.collect()}


def fit_pooled(scaled: DataFrame, cols: list[str] = FEATURES, look_back: int = LOOK_BACK) -> dict:
    """Ridge regression of the step from the last close to the next on the window.

    Working on the step makes the last-value forecast the limit of strong regularisation.  Empty when
    no train split is longer than the look-back.
    """
    width = look_back * len(cols)
    grams = _grams(scaled, cols, look_back)
    train, val = grams.get("train"), grams.get("val")
    if train is None:
        return {}
    n = train[0, 0]
    mean = train[0, 1:] / n
    centred = train[1:, 1:] - n * np.outer(mean, mean)
    a, b = centred[:-1, :-1], centred[:-1, -1]
    fits = [np.linalg.solve(a + p * n * np.eye(width), b) for p in PENALTIES]
    best = 0
    if val is not None:
        basis = np.column_stack([-mean, np.eye(width + 1)])  # (x - mean, step - mean)
        v = basis @ val @ basis.T
        residual = [np.r_[-w, 1.0] for w in fits]
        best = int(np.argmin([r @ v @ r for r in residual]))
    return {
        "coef": fits[best], "mean": mean[:-1], "const": float(mean[-1]), "penalty": PENALTIES[best],
        "checked": val is not None,
    }


def shared_record(fit: dict, cols: list[str], look_back: int) -> dict[str, list[float]]:
    """What all series of a fit have in common, as model parameters."""
    return {
        "coef": [float(v) for v in fit["coef"]], "mean": [float(v) for v in fit["mean"]], "const": [fit["const"]],
        "shape": _shape(cols, look_back), "penalty": [fit["penalty"], float(fit["checked"])],
    }


def _shape(cols: list[str], look_back: int) -> list[float]:
    return [float(look_back), float(len(cols)), float(cols.index(TARGET))]


def series_windows(scaled: DataFrame, cols: list[str] = FEATURES, look_back: int = LOOK_BACK, origin: str = "val_end") -> DataFrame:
    """Model parameter rows of the series without what they share: the last window and the shape of the regression.

    A series whose train split is not longer than the look-back gets an error instead.
    """
    rows = last_sequence(scaled, cols, look_back, origin).join(sequence_length_guard(scaled, look_back), SERIES)
    error = F.coalesce(F.col("too_short"), F.when(F.size("x") < look_back, TOO_SHORT))
    own = F.create_map(F.lit("window"), F.flatten("x"), F.lit("shape"), F.array(*map(F.lit, _shape(cols, look_back))))
    return rows.select(
        SERIES, F.lit(MODEL).alias("model"), "fit_end", F.when(error.isNull(), own).alias("params"), error.alias("error"))


def fit_sequence_regression(
    scaled: DataFrame, cols: list[str] = FEATURES, look_back: int = LOOK_BACK, origin: str = "val_end"
) -> DataFrame:
    """Pooled fit.  Returns model parameter rows: one without a series, which holds the coefficients once for all series,
    and one for each series, which holds its last window.

    Without a train split longer than the look-back there are errors only, and no row without a series.
    """
    fit = fit_pooled(scaled, cols, look_back)
    rows = series_windows(scaled, cols, look_back, origin)
    if not fit:
        none = F.lit(None).cast("map<string,array<double>>")
        return rows.withColumns({"params": none, "error": F.lit(TOO_SHORT)})
    record = [(None, MODEL, None, shared_record(fit, cols, look_back), None)]
    return rows.unionByName(scaled.sparkSession.createDataFrame(record, MODEL_PARAMS))


def with_shared(params: DataFrame) -> DataFrame:
    """Rows of series that can be forecast, with ``coef``, ``mean`` and ``const`` as columns: a series' own ones where its row
    holds them, else those of the row of its model without a series.

    That row is one for each pooled model and as wide as its regression, which bounds the broadcast.
    """
    p, names = F.col("params"), ["coef", "mean", "const"]
    shared = params.where(F.col(SERIES).isNull() & p["coef"].isNotNull() & p["window"].isNull()).select(
        "model", *(p[c].alias(f"_{c}") for c in names))
    both = params.where(p["window"].isNotNull()).join(F.broadcast(shared), "model", "left")
    full = both.withColumns({c: F.coalesce(p[c], F.col(f"_{c}")) for c in names})
    return full.where(F.col("coef").isNotNull()).drop(*(f"_{c}" for c in names))


BLOCK_PASSES = 16  # passes that are rolled on together
BLOCK_VALUES = 1 << 22  # window values of all passes of a block
STEP_ROWS = 1 << 16  # rows that a task holds before it sends them on


def mask_key(i: Column, seed: int) -> Column:
    """32 bits that belong to pass ``i`` of a series."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.col(SERIES), i, F.lit(seed))), 1, 8), 16, 10).cast("long")


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 32-bit finaliser of MurmurHash3, on an array of uint32."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def kept(keys: np.ndarray, step: int, width: int, dropout: float) -> np.ndarray:
    """Which of ``width`` inputs stay in a step: a hash of (key, step, input), so no draw depends on an earlier one."""
    stride = np.uint32(0x9E3779B9)
    at_step = _mixed(keys + np.uint32(step * int(stride) & 0xFFFFFFFF))
    return _mixed(at_step[..., None] + np.arange(width, dtype="uint32") * stride) >= np.uint32(dropout * 2**32)


def _alike(batches):
    """Parts of batches whose regressions have one shape, longest horizon first, small enough to be rolled on together."""
    for p in batches:
        p = p[p["h"] > 0]
        shapes = p["shape"].map(tuple)
        for shape, part in p.groupby(shapes, sort=False):
            width = int(shape[0] * shape[1])
            rows = max(1, BLOCK_VALUES // (width * BLOCK_PASSES))
            part = part.sort_values("h", ascending=False, kind="stable").reset_index(drop=True)
            for start in range(0, len(part), rows):
                yield part[start:start + rows].reset_index(drop=True), int(shape[1]), int(shape[2])


def _rolled(p: pd.DataFrame, k: int, target: int, keys: np.ndarray | None, dropout: float):
    """(step, predictions of the series that go on, by pass): each prediction is fed back as the close, the other
    features are held, the window slides.  All series and passes move at once."""
    coef, mean = np.stack(p["coef"])[:, None], np.stack(p["mean"])[:, None]
    const, h = np.array([c[0] for c in p["const"]])[:, None], p["h"].to_numpy()
    window = np.repeat(np.stack(p["window"])[:, None], 1 if keys is None else keys.shape[1], axis=1)
    for step in range(1, int(h[0]) + 1):
        n = int(np.searchsorted(-h, -step, "right"))
        window = window[:n]
        deviation = window - mean[:n]
        if keys is not None:
            deviation *= kept(keys[:n], step, window.shape[2], dropout) / (1.0 - dropout)
        last = window[:, :, -k:].copy()
        last[:, :, target] += const[:n] + np.matmul(deviation, coef[:n].swapaxes(1, 2))[:, :, 0]
        window = np.concatenate([window[:, :, k:], last], axis=2)
        yield step, last[:, :, target]


def _sent(p: pd.DataFrame, values, first_pass: int):
    """Rows (series, model, pass, step, value) of what ``_rolled`` gives."""
    held, rows, h = [], 0, int(p["h"].iloc[0])
    for step, v in values:
        n, passes = v.shape
        at = np.repeat(np.arange(n), passes)
        held.append(pd.DataFrame({
            SERIES: p[SERIES].to_numpy()[at], "model": p["model"].to_numpy()[at], "pass": np.tile(np.arange(passes, dtype="int32") + first_pass, n),
            "step": np.full(n * passes, step, "int32"), "value": v.ravel()}))
        rows += n * passes
        if rows >= STEP_ROWS or step == h:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0


def _inputs(params: DataFrame, horizon: Column, *more: Column) -> DataFrame:
    p = F.col("params")
    return with_shared(params).select(
        SERIES, "model", *(p[c].alias(c) for c in ("window", "shape")), "coef", "mean", "const", F.coalesce(horizon.cast("int"), F.lit(0)).alias("h"), *more)


def _keys(passes: int, seed: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(passes)), lambda i: mask_key(i, seed)).alias("keys")


PASS_ROWS = f"{SERIES} string, model string, pass int, step int, value double"
MOMENTS = f"{SERIES} string, model string, step int, n long, mean double, m2 double"


def forecast_recursive(params: DataFrame, horizon: int | Column = HORIZON) -> DataFrame:
    """Deterministic forecast in scaled units."""
    h = horizon if isinstance(horizon, Column) else F.lit(horizon)

    def path(batches):
        for p, k, target in _alike(batches):
            yield from _sent(p, _rolled(p, k, target, None, 0.0), 1)

    return _inputs(params, h).mapInPandas(path, PASS_ROWS).select(SERIES, "model", "step", F.col("value").alias("forecast"))


def fan_out_stochastic(
    params: DataFrame, horizon: int | Column = HORIZON, passes: int = STOCHASTIC_PASSES,
    dropout: float = DROPOUT, seed: int = SEED,
) -> DataFrame:
    """Every series forecast ``passes`` times under random dropout: (series, model, pass, step, value).

    What is dropped is a hash of (series, pass, step, input), so a task that is run again gives the same
    rows, and so does any other cut of the series or passes.
    """
    h = horizon if isinstance(horizon, Column) else F.lit(horizon)

    def paths(batches):
        for p, k, target in _alike(batches):
            keys = np.stack(p["keys"]).astype("uint32")
            for start in range(0, passes, BLOCK_PASSES):
                yield from _sent(p, _rolled(p, k, target, keys[:, start:start + BLOCK_PASSES], dropout), start + 1)

    return _inputs(params, h, _keys(passes, seed)).mapInPandas(paths, PASS_ROWS)


def stochastic_moments(
    params: DataFrame, horizon: int | Column = HORIZON, passes: int = STOCHASTIC_PASSES,
    dropout: float = DROPOUT, seed: int = SEED,
) -> DataFrame:
    """(series, model, step, n, mean, m2) of the same passes, m2 being the sum of squared distances from the mean.

    Blocks of passes are merged where they are made, so only a row per series and step leaves the task.
    """
    h = horizon if isinstance(horizon, Column) else F.lit(horizon)

    def moments(batches):
        for p, k, target in _alike(batches):
            keys = np.stack(p["keys"]).astype("uint32")
            mean, m2 = np.zeros((len(p), int(p["h"].iloc[0]))), np.zeros((len(p), int(p["h"].iloc[0])))
            for start in range(0, passes, BLOCK_PASSES):
                block = keys[:, start:start + BLOCK_PASSES]
                for step, v in _rolled(p, k, target, block, dropout):
                    at, size = (slice(0, len(v)), step - 1), block.shape[1]
                    own = v.mean(axis=1)
                    apart = own - mean[at]
                    m2[at] += ((v - own[:, None]) ** 2).sum(axis=1) + apart**2 * (start * size / (start + size))
                    mean[at] += apart * (size / (start + size))
            for first in range(0, mean.shape[1], max(1, STEP_ROWS // len(p))):
                steps = np.arange(first, min(mean.shape[1], first + max(1, STEP_ROWS // len(p))))
                row, col = np.nonzero(steps[None] < p["h"].to_numpy()[:, None])
                yield pd.DataFrame({
                    SERIES: p[SERIES].to_numpy()[row], "model": p["model"].to_numpy()[row], "step": (steps[col] + 1).astype("int32"),
                    "n": np.full(len(row), passes), "mean": mean[row, steps[col]], "m2": m2[row, steps[col]]})

    return _inputs(params, h, _keys(passes, seed)).mapInPandas(moments, MOMENTS)


def stochastic_interval(passes: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """Mean over the passes with a band of z population deviations, per step."""
    half = z_value(confidence) * F.col("_sd")
    return (
        passes.groupBy(SERIES, "model", "step")
        .agg(F.avg("value").alias("forecast"), F.stddev_pop("value").alias("_sd"))
        .select(SERIES, "model", "step", "forecast", (F.col("forecast") - half).alias("lower"),
                (F.col("forecast") + half).alias("upper"))
    )


def stochastic_forecast(
    params: DataFrame, horizon: int | Column = HORIZON, confidence: float = CONFIDENCE,
    passes: int = STOCHASTIC_PASSES, dropout: float = DROPOUT, seed: int = SEED,
) -> DataFrame:
    """Mean over the passes with a band of z population deviations, per step, without a shuffle."""
    half = z_value(confidence) * F.sqrt(F.col("m2") / F.col("n"))
    return stochastic_moments(params, horizon, passes, dropout, seed).select(
        SERIES, "model", "step", F.col("mean").alias("forecast"), (F.col("mean") - half).alias("lower"), (F.col("mean") + half).alias("upper"))
