"""ARIMA for all series at once.

Differencing order from KPSS statistics in windows, coefficients by conditional least squares
(Hannan-Rissanen for the moving-average part), order by AIC.  One Gram matrix per series for the
largest order serves every smaller order as a sub-block, so the search costs no further pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions.numeric import dot, z_value
from barline.operators.linear import gram_sums, solve, unpack
from barline.operators.split import train_plus_val
from barline.schema import CONFIDENCE, HORIZON, KPSS_CRITICAL, MAX_D, MAX_P, MAX_Q, SERIES, TARGET, by_date, by_series
from barline.sources.layout import cut_lineage

LONG_AR = 10  # lags of the first-stage autoregression that supplies residuals

FIT = T.StructType([
    T.StructField("order", T.ArrayType(T.DoubleType())),
    T.StructField("const", T.DoubleType()),
    T.StructField("ar", T.ArrayType(T.DoubleType())),
    T.StructField("ma", T.ArrayType(T.DoubleType())),
    T.StructField("sigma2", T.DoubleType()),
    T.StructField("aic", T.DoubleType()),
    T.StructField("error", T.StringType()),
])


def lag(c: str, k: int = 1) -> Column:
    return F.lag(c, k).over(by_date())


def _kpss(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the KPSS level statistic of ``value`` per series.

    The Bartlett long-run variance equals the mean square of moving sums of width l + 1 over the
    demeaned values, zero-padded at both ends.  The width differs by series, so the frame is a range
    over position / (l + 1).
    """
    n = F.count(value).over(by_series())
    width = (F.floor(F.sqrt(F.col("_n")) * 3 / 13) + 1).cast("double")
    framed = (
        df.withColumns({"_n": n, "_e": F.coalesce(F.col(value) - F.avg(value).over(by_series()), F.lit(0.0))})
        .withColumn("_u", F.row_number().over(by_date()) / width)
        .withColumns({
            "_s": F.sum("_e").over(by_date()),
            "_m": F.expr(
                f"sum(_e) over (partition by {SERIES} order by _u range between 0.9999999D preceding and current row)"
            ),
            "_from_end": F.count("*").over(by_series()) - F.row_number().over(by_date()),
        })
    )
    s2 = F.col("_s") * F.col("_s")
    padded = F.when(F.col("_from_end").between(1, width - 1), s2).otherwise(0.0)
    whole = by_series()
    variance = F.sum(F.col("_m") * F.col("_m") + padded).over(whole) / (F.col("_n") * width)
    statistic = F.try_divide(F.sum(s2).over(whole) / (F.col("_n") * F.col("_n")), variance)
    return framed.withColumn(name, statistic).drop("_n", "_e", "_u", "_s", "_m", "_from_end")


def difference_order(train: DataFrame, value: str = TARGET, max_d: int = MAX_D) -> DataFrame:
    """Per series: KPSS statistics of the values and of their differences, and the order d they imply."""
    rows = train.select(SERIES, "date", F.col(value).alias("_y"), (F.col(value) - lag(value)).alias("_dy"))
    tested = _kpss(_kpss(rows, "_y", "kpss_level"), "_dy", "kpss_difference")
    trending = F.coalesce(F.col("kpss_level") > KPSS_CRITICAL, F.lit(False))
    still = F.coalesce(F.col("kpss_difference") > KPSS_CRITICAL, F.lit(False))
    order = F.when(~trending, 0).when(~still, 1).otherwise(2)
    return tested.groupBy(SERIES).agg(
        F.first("kpss_level").alias("kpss_level"), F.first("kpss_difference").alias("kpss_difference")
    ).withColumn("d", F.least(order, F.lit(max_d)).cast("int"))


def _difference(d: Column) -> Column:
    first = F.col("y") - lag("y")
    second = F.col("y") - 2 * lag("y") + lag("y", 2)
    return F.when(d == 0, F.col("y")).when(d == 1, first).otherwise(second)


def _long_ar(lags: int):
    """Scalar Pandas UDF: Gram array to (constant, coefficients); NULL when singular."""

    @F.pandas_udf("array<double>")
    def fitted(gram: pd.Series) -> pd.Series:
        g = unpack(gram, lags + 2)
        coef, ok = solve(g[:, :-1, :-1], g[:, :-1, -1])
        return pd.Series([list(c) if o else None for c, o in zip(coef, ok)])

    return fitted


def _array(names: list[str]) -> Column:
    return F.array(*names) if names else F.array().cast("array<double>")


def _max_root(coef: np.ndarray) -> np.ndarray:
    """Largest modulus among the companion eigenvalues of each coefficient row; below 1 is stable."""
    size, order = coef.shape
    if order == 0:
        return np.zeros(size)
    companion = np.zeros((size, order, order))
    companion[:, 0, :] = coef
    companion[:, np.arange(1, order), np.arange(order - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(axis=1)


def _select_order(max_p: int, max_q: int, fixed: tuple[int, int] | None, tail: int):
    """Scalar Pandas UDF: Gram array and d to the fit with the smallest AIC among all (p, q).

    Fits that are not stationary or not invertible are passed over.
    """
    grid = [fixed] if fixed else [(p, q) for p in range(max_p + 1) for q in range(max_q + 1)]
    k = max_p + max_q + 2

    @F.pandas_udf(FIT)
    def best(gram: pd.Series, d: pd.Series) -> pd.DataFrame:
        g = unpack(gram, k)
        n, size = g[:, 0, 0], len(g)
        score = np.full(size, np.inf)
        order = np.zeros((size, 2))
        coef = np.zeros((size, k - 1))
        sigma2 = np.full(size, np.nan)
        drift = (d.to_numpy() < 2)
        for p, q in grid:
            for with_const in (True, False):
                cols = [0] * with_const + list(range(1, 1 + p)) + list(range(1 + max_p, 1 + max_p + q))
                a, b = g[:, cols][:, :, cols], g[:, cols, -1]
                w, ok = solve(a, b)
                w = np.where(ok[:, None], w, 0.0)
                rss = g[:, -1, -1] - 2 * (w * b).sum(1) + np.einsum("ni,nij,nj->n", w, a, w)
                free = len(cols) + 1
                ok &= (drift == with_const) & (n > free + 1)
                ar = w[:, with_const:with_const + p]
                ma = w[:, with_const + p:]
                ok &= (_max_root(ar) < 0.999) & (_max_root(-ma) < 0.999)
                rss = np.maximum(rss, 1e-12 * np.maximum(g[:, -1, -1], 1e-300))
                safe_n = np.maximum(n, 1)
                aic = np.where(ok, n * np.log(rss / safe_n) + 2 * free, np.inf)
                better = aic < score - 1e-9
                score[better] = aic[better]
                order[better] = (p, q)
                sigma2[better] = (rss / np.maximum(n - len(cols), 1))[better]
                coef[better] = 0.0
                coef[np.ix_(np.flatnonzero(better), cols)] = w[better]
        found = np.isfinite(score)
        score = np.where(found, score, np.nan)

        def padded(part):
            out = np.zeros((size, tail))
            out[:, : part.shape[1]] = part
            return list(out)

        return pd.DataFrame({
            "order": [[float(p), float(x), float(q)] for (p, q), x in zip(order, d)],
            "const": coef[:, 0],
            "ar": padded(coef[:, 1:1 + max_p]),
            "ma": padded(coef[:, 1 + max_p:]),
            "sigma2": sigma2,
            "aic": score,
            "error": [None if f else ("too few rows" if m < 3 else "singular") for f, m in zip(found, n)],
        })

    return best


def fit_arima(
    scaled: DataFrame,
    max_p: int = MAX_P,
    max_q: int = MAX_Q,
    order: tuple[int, int, int] | None = None,
    origin: str = "val_end",
) -> DataFrame:
    """Fit on the train rows of the scaled close; the forecast state continues to the origin.

    ``order`` fixes (p, d, q); otherwise d comes from :func:`difference_order` and (p, q) from AIC over
    a common sample.  Returns model parameter rows.  The two small tables in between, one row per
    series each, are stored, since several later steps read them.
    """
    if order:
        max_p, _, max_q = order
    tail = max(max_p, max_q, 1)  # values of the state that a forecast looks back on
    history = scaled if origin == "last" else train_plus_val(scaled)
    rows = history.select(SERIES, "date", "split", F.col(TARGET).alias("y"))
    if order:
        rows = rows.withColumn("d", F.lit(order[1]))
    else:
        d = cut_lineage(difference_order(rows.where("split = 'train'"), "y").select(SERIES, "d"))
        rows = rows.join(d, SERIES)
    rows = rows.withColumn("w", _difference(F.col("d")))

    if max_q:
        long_lags = [f"w{i}" for i in range(1, LONG_AR + 1)]
        lagged = rows.withColumns({c: lag("w", i) for i, c in enumerate(long_lags, 1)})
        train = lagged.where("split = 'train'")
        stage1 = cut_lineage(gram_sums(train, F.array(*long_lags), F.col("w")).select(
            SERIES, _long_ar(LONG_AR)("gram").alias("long")
        ))
        fitted = dot("long", [F.lit(1.0), *[F.col(c) for c in long_lags]])
        # A flat series has a singular autoregression; without residuals it still fits (0, d, 0).
        residual = F.when(F.col("long").isNull(), 0.0).otherwise(F.col("w") - fitted)
        rows = lagged.join(stage1, SERIES, "left").select(
            SERIES, "date", "split", "y", "d", "w", residual.alias("e")
        )
    else:
        rows = rows.withColumn("e", F.lit(0.0))

    w_lags = [f"w{i}" for i in range(1, max_p + 1)]
    e_lags = [f"e{i}" for i in range(1, max_q + 1)]
    lagged = rows.withColumns({
        **{c: lag("w", i) for i, c in enumerate(w_lags, 1)},
        **{c: lag("e", i) for i, c in enumerate(e_lags, 1)},
        "w_tail": F.array(F.col("w"), *[lag("w", i) for i in range(1, tail)]),
        "e_tail": F.array(F.col("e"), *[lag("e", i) for i in range(1, tail)]),
        "dy": F.col("y") - lag("y"),
    })
    gram = gram_sums(lagged.where("split = 'train'"), _array(w_lags + e_lags), F.col("w"))
    state = lagged.groupBy(SERIES).agg(
        F.max("date").alias("fit_end"),
        F.first("d").alias("d"),
        F.max_by(F.struct("y", "dy", "w_tail", "e_tail"), "date").alias("s"),
    )
    fixed = (order[0], order[2]) if order else None
    fit = _select_order(max_p, max_q, fixed, tail)("gram", "d")

    def filled(c: str) -> Column:
        return F.transform(F.col(c), lambda v: F.coalesce(v, F.lit(0.0)))

    one = F.array
    return (
        state.join(gram, SERIES, "left")
        .select(SERIES, "fit_end", "s", fit.alias("f"))
        .select(
            SERIES,
            F.lit("arima").alias("model"),
            "fit_end",
            F.when(F.col("f.error").isNull(), F.create_map(
                F.lit("order"), F.col("f.order"),
                F.lit("const"), one(F.col("f.const")),
                F.lit("ar"), F.col("f.ar"),
                F.lit("ma"), F.col("f.ma"),
                F.lit("sigma2"), one(F.col("f.sigma2")),
                F.lit("aic"), one(F.col("f.aic")),
                F.lit("w"), filled("s.w_tail"),
                F.lit("e"), filled("s.e_tail"),
                F.lit("last"), one(F.col("s.y"), F.coalesce(F.col("s.dy"), F.lit(0.0))),
            )).alias("params"),
            F.col("f.error").alias("error"),
        )
    )


PATH = T.StructType([
    T.StructField(SERIES, T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("sigma2", T.DoubleType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("var", T.DoubleType()),
])
STEP_ROWS = 1 << 16  # rows of path that a task holds before it sends them on


def _padded(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for row, v in zip(out, values):
        row[: len(v)] = v
    return out


def _companion(ar: np.ndarray, ma: np.ndarray, const: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The linear map of one step, a matrix per series, on (w lags, e lags, level, slope, 1)."""
    size, tail = ar.shape
    level, slope, one = 2 * tail, 2 * tail + 1, 2 * tail + 2
    new = np.concatenate([ar, ma, np.zeros((size, 2)), const[:, None]], axis=1)
    m = np.zeros((size, 2 * tail + 3, 2 * tail + 3))
    m[:, 0] = new
    for lag_of in range(1, tail):
        m[:, lag_of, lag_of - 1] = 1.0
        m[:, tail + lag_of, tail + lag_of - 1] = 1.0
    m[:, level] = new
    m[:, slope] = new
    m[d == 1, level, level] += 1.0
    m[d == 2, slope, slope] += 1.0
    m[d == 2, level] = m[d == 2, slope]
    m[d == 2, level, level] += 1.0
    m[:, one, one] = 1.0
    return m


def _steps(batches):
    """Arrow batches of parameters to rows of steps: one product of matrices a step, over all series of a batch.

    The response to a unit shock moves by the same map as the path, so both are columns of one state; its
    level is the psi weight that the variance sums.  Series whose horizon is reached drop out.
    """
    for p in batches:
        p = p[p["h"] > 0].sort_values("h", ascending=False, kind="stable").reset_index(drop=True)
        if p.empty:
            continue
        tail = max(int(max(p[c].str.len().max() for c in ("ar", "ma", "w", "e"))), 1)
        ar, ma, w, e = (_padded(p[c], tail) for c in ("ar", "ma", "w", "e"))
        d, h = p["d"].to_numpy(), p["h"].to_numpy()
        move = _companion(ar, ma, p["const"].to_numpy(), d)
        state = np.zeros((len(p), 2 * tail + 3, 2))
        state[:, :, 0] = np.concatenate([w, e, p[["y", "dy"]].to_numpy(), np.ones((len(p), 1))], axis=1)
        variance = np.zeros(len(p))
        held, rows = [], 0
        for step in range(1, int(h[0]) + 1):
            n = int(np.searchsorted(-h, -step, "right"))
            state = np.matmul(move[:n], state[:n])
            if step == 1:
                state[:, [0, tail, 2 * tail, 2 * tail + 1], 1] = 1.0
            variance = variance[:n] + state[:, 2 * tail, 1] ** 2
            held.append((step, state[:, 2 * tail, 0].copy(), variance))
            rows += n
            if rows >= STEP_ROWS or step == h[0]:
                at = np.concatenate([np.arange(len(y)) for _, y, _ in held])
                out = p.loc[at, [SERIES, "model", "sigma2"]].reset_index(drop=True)
                out["step"] = np.repeat(np.array([k for k, _, _ in held], "int32"), [len(y) for _, y, _ in held])
                out["forecast"] = np.concatenate([y for _, y, _ in held])
                out["var"] = np.concatenate([v for _, _, v in held])
                yield out
                held, rows = [], 0


def arima_paths(params: DataFrame, horizon: Column) -> DataFrame:
    """(series, model, sigma2, step, forecast, var): the point path and the variance factor of each step.

    Work and memory are linear in the horizon, which may differ by series.
    """
    p = F.col("params")
    return params.where(F.col("params").isNotNull()).select(
        SERIES, "model", p["sigma2"][0].alias("sigma2"), F.coalesce(horizon.cast("int"), F.lit(0)).alias("h"), p["order"][1].alias("d"),
        p["const"][0].alias("const"), *(p[c].alias(c) for c in ("ar", "ma", "w", "e")), p["last"][0].alias("y"), p["last"][1].alias("dy"),
    ).mapInPandas(_steps, PATH)


def arima_interval(paths: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """Analytic band of a path: ``forecast ± z * sigma * sqrt(sum psi^2)``."""
    half = z_value(confidence) * F.sqrt(F.col("sigma2") * F.col("var"))
    return paths.select(
        SERIES, "model", "step", "forecast",
        (F.col("forecast") - half).alias("lower"), (F.col("forecast") + half).alias("upper"),
    )


def forecast_arima(params: DataFrame, horizon: int | Column = HORIZON, confidence: float = CONFIDENCE) -> DataFrame:
    """Point forecast with its analytic band, in scaled units."""
    h = horizon if isinstance(horizon, Column) else F.lit(horizon)
    return arima_interval(arima_paths(params, h), confidence)
