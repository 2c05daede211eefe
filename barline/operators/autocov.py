"""ARIMA order search from autocovariances: one pass over the rows, then array arithmetic on a row per series.

Lagged products of the differenced, centred train values are summed once per series.  Durbin-Levinson turns them
into the autoregressions of all orders, and these into the coefficients of the innovations algorithm, which are
estimates of the psi weights.  Each (p, q) is a row that solves for its coefficients from psi weights
(q > 0) or takes the autoregression as it is (q = 0); its error variance is the quadratic form of its own truncated pi
weights in the autocovariances, so orders are compared on one sample without going back to the rows.

Rows are exchanged by series twice, once for the differencing order and once for everything else, and no Python runs.
Null values are left out of sums.  A flat series gets (0, d, 0); fewer than ``LEAST`` differenced train values
give an error row; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.arima import _difference, difference_order, lag
from barline.operators.split import train_plus_val
from barline.schema import MAX_P, MAX_Q, SERIES, TARGET, by_date, by_series

LAGS = 16  # autocovariances, order of the longest autoregression, and pi weights kept
LEAST = 3  # differenced train values of a series
EDGE = 0.999  # partial autocorrelations of a fit that counts as stationary and invertible stay below


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _dot(a: Column, b: Column) -> Column:
    """Inner product up to the shorter of two arrays."""
    return _total(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))))


def _upto(n: Column | int, first: int = 1) -> Column:
    """first, ..., n; empty where n is smaller."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(n >= first, F.sequence(F.lit(first), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _at(values: Column, i: Column | int) -> Column:
    return F.coalesce(F.get(values, F.lit(i) if isinstance(i, int) else i), F.lit(0.0))


def durbin_levinson(gamma: Column, order: int = LAGS) -> Column:
    """Coefficients of the best linear predictors from 0, 1, ..., ``order`` values before, given autocovariances."""
    nothing = F.array().cast("array<double>")

    def step(s: Column, k: Column) -> Column:
        known = F.reverse(F.slice(gamma, F.lit(2), k - 1))
        partial = F.coalesce(F.try_divide(_at(gamma, k) - _dot(s["phi"], known), s["v"]), F.lit(0.0))
        return _let(partial, lambda a: _let(
            F.concat(F.zip_with(s["phi"], F.reverse(s["phi"]), lambda x, y: x - a * y), F.array(a)),
            lambda phi: F.struct(phi.alias("phi"), (s["v"] * (1 - a * a)).alias("v"), F.concat(s["all"], F.array(phi)).alias("all"))))

    start = F.struct(nothing.alias("phi"), _at(gamma, 0).alias("v"), F.array(nothing).alias("all"))
    return F.aggregate(_upto(order), start, step, lambda s: s["all"])


def innovations(predictors: Column, count: int, order: int = LAGS) -> Column:
    """Weights 1, psi_1, ..., psi_count of the last innovations in the predictor of the given order.

    With theta(m, 0) = 1, theta(m, j) = sum over i of phi(m, i) theta(m - i, j - i): a value is its innovation plus what
    its own predictor makes of the values before, each of which is such a sum itself.
    """
    def step(theta: Column, j: Column) -> Column:
        def entry(m: Column) -> Column:
            return F.when(m >= j, F.aggregate(_upto(j), F.lit(0.0), lambda s, i: s + _at(F.get(predictors, m), i - 1) * _at(F.get(theta, j - i), m - i))).otherwise(0.0)

        return F.concat(theta, F.array(F.transform(_upto(order, 0), entry)))

    table = F.aggregate(_upto(count), F.array(F.transform(_upto(order, 0), lambda m: F.lit(1.0))), step)
    return F.transform(table, lambda of_j: _at(of_j, order))


def solve(rows: Column, size: Column) -> Column:
    """Solution of linear equations given as rows (coefficients, right side), by elimination with pivots; null if singular."""
    def step(left: Column, c: Column) -> Column:
        """Left: rows not used yet and rows used, both cleared of the columns before c."""
        pivot = F.aggregate(left["open"], F.get(left["open"], F.lit(0)), lambda a, b: F.when(F.abs(F.get(b, c)) > F.abs(F.get(a, c)), b).otherwise(a))

        def cleared(rows_: Column, unit: Column) -> Column:
            return F.transform(rows_, lambda r: F.zip_with(r, unit, lambda x, u: x - F.get(r, c) * u))

        return _let(pivot, lambda p: _let(F.transform(p, lambda x: F.try_divide(x, F.get(p, c))), lambda unit: F.struct(
            cleared(F.filter(left["open"], lambda r, i: i != F.array_position(left["open"], p).cast("int") - 1), unit).alias("open"),
            F.concat(cleared(left["used"], unit), F.array(unit)).alias("used"))))

    start = F.struct(rows.alias("open"), F.slice(rows, 1, 0).alias("used"))
    solved = F.aggregate(_upto(size - 1, 0), start, step, lambda s: F.transform(s["used"], lambda r: F.get(r, size)))
    return F.when(~F.exists(solved, lambda x: x.isNull()), solved)


def stable(coef: Column) -> Column:
    """Whether 1 - c1 z - c2 z^2 - ... has no root on or inside the unit circle: all partial autocorrelations are below 1."""
    def step(s: Column, k: Column) -> Column:
        return _let(_at(s["c"], F.size(s["c"]) - 1), lambda r: _let(F.slice(s["c"], F.lit(1), F.size(s["c"]) - 1), lambda c: F.struct(
            F.zip_with(c, F.reverse(c), lambda x, y: F.coalesce(F.try_divide(x + r * y, 1 - r * r), F.lit(0.0))).alias("c"),
            (s["ok"] & (F.abs(r) < EDGE)).alias("ok"))))

    return F.aggregate(_upto(F.size(coef)), F.struct(coef.alias("c"), F.lit(True).alias("ok")), step, lambda s: s["ok"])


def pi_weights(ar: Column, ma: Column, count: int = LAGS) -> Column:
    """1, pi_1, ..., pi_count: what the residual is as a sum of values."""
    return F.aggregate(_upto(count), F.array(F.lit(1.0)), lambda pi, j: F.concat(pi, F.array(-_at(ar, j - 1) - _dot(ma, F.reverse(pi)))))


def _sums(scaled: DataFrame, d: int | None, origin: str) -> DataFrame:
    """A row per series: n, mean, gamma (autocovariances at lags 0 to LAGS), d, and the last values before the origin."""
    history = scaled if origin == "last" else train_plus_val(scaled)
    rows = history.select(SERIES, "date", "split", F.col(TARGET).alias("y"))
    if d is None:
        orders = difference_order(rows.where("split = 'train'"), "y").select(SERIES, "d")
        rows = rows.join(orders.hint("shuffle_hash"), SERIES, "left").withColumn("d", F.coalesce("d", F.lit(0)))
    else:
        rows = rows.withColumn("d", F.lit(d))
    rows = rows.withColumns({"w": _difference(F.col("d")), "dy": F.col("y") - lag("y")}).withColumn("t", F.when(F.col("split") == "train", F.col("w")))
    rows = rows.withColumn("m", F.when(F.col("d") < 2, F.avg("t").over(by_series())).otherwise(0.0)).withColumn("x", F.col("t") - F.col("m"))
    rows = rows.withColumns({f"x{k}": lag("x", k) for k in range(1, LAGS + 1)}).withColumn("from_end", F.count("*").over(by_series()) - F.row_number().over(by_date()))
    products = [F.coalesce(F.sum(F.col("x") * F.col(f"x{k}" if k else "x")), F.lit(0.0)) for k in range(LAGS + 1)]
    tail = F.collect_list(F.when(F.col("from_end") < LAGS + max(MAX_P, MAX_Q, 8), F.struct("date", "w")))
    return rows.groupBy(SERIES).agg(
        F.max("date").alias("fit_end"), F.first("d").alias("d"), F.count("x").alias("n"), F.coalesce(F.first("m"), F.lit(0.0)).alias("mean"),
        F.array(*products).alias("gamma"), F.max_by(F.struct("y", "dy"), "date").alias("s"), F.sort_array(tail, asc=False).alias("tail"),
    ).withColumns({
        "gamma": F.transform("gamma", lambda g: F.coalesce(F.try_divide(g, F.col("n")), F.lit(0.0))),
        "tail": F.transform("tail", lambda t: F.coalesce(t["w"], F.col("mean")))})


def fit_autocov(scaled: DataFrame, max_p: int = MAX_P, max_q: int = MAX_Q, order: tuple[int, int, int] | None = None, origin: str = "val_end") -> DataFrame:
    """Parameter rows of :func:`barline.operators.arima.forecast_arima`, estimated from autocovariances.

    ``order`` fixes (p, d, q); p + q is at most ``LAGS``.  Among the (p, q) that are stationary and invertible the
    smallest AIC wins, ties go to the smaller p, then q.
    """
    grid = [(order[0], order[2])] if order else [(p, q) for p in range(max_p + 1) for q in range(max_q + 1)]
    most = max(p + q for p, q in grid)
    if most > LAGS:
        raise ValueError(f"p + q must be at most {LAGS}, got {most}")
    width = max(max(pair) for pair in grid) or 1
    sums = _sums(scaled, order[1] if order else None, origin)
    rows = sums.withColumn("phi", durbin_levinson(F.col("gamma"))).withColumn("psi", innovations(F.col("phi"), most) if most else F.array(F.lit(1.0)))
    pairs = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in grid))
    rows = rows.select("*", F.inline(pairs))

    p, q, psi = F.col("p"), F.col("q"), F.col("psi")

    def weight(k: Column) -> Column:
        return F.when(k >= 0, _at(psi, F.greatest(k, F.lit(0)))).otherwise(0.0)

    equations = F.transform(_upto(p), lambda r: F.concat(F.transform(_upto(p), lambda i: weight(q + r - i)), F.array(weight(q + r))))
    rows = rows.withColumn("ar", F.when(q == 0, F.get("phi", p)).when(p == 0, F.array().cast("array<double>")).otherwise(solve(equations, p)))
    rows = rows.withColumn("ma", F.transform(_upto(q), lambda j: weight(j) - F.aggregate(
        _upto(p), F.lit(0.0), lambda s, i: s + _at(F.col("ar"), i - 1) * weight(j - i))))
    rows = rows.withColumn("pi", pi_weights(F.col("ar"), F.col("ma")))
    lagged = F.transform("pi", lambda x, i: x * _dot(F.col("pi"), F.transform("pi", lambda y, j: _at(F.col("gamma"), F.abs(i - j)))))
    free = p + q + F.when(F.col("d") < 2, 1).otherwise(0)
    rows = rows.withColumns({"v": F.greatest(_total(lagged), 1e-12 * _at(F.col("gamma"), 0), F.lit(1e-300)), "free": free})
    good = F.col("ar").isNotNull() & stable(F.col("ar")) & stable(F.transform("ma", lambda x: -x)) & (F.col("n") > free + 2) & (F.col("n") >= LEAST)
    rows = rows.withColumn("aic", F.when(good, F.col("n") * F.ln("v") + 2.0 * (free + 1)))

    first = [F.first(c).alias(c) for c in ("fit_end", "d", "n", "mean", "s", "tail")]
    best = rows.groupBy(SERIES).agg(*first, F.min(F.when(F.col("aic").isNotNull(), F.struct("aic", "p", "q", "ar", "ma", "pi", "v", "free"))).alias("f"))
    f = F.col("f")

    def padded(c: Column) -> Column:
        return F.slice(F.concat(c, F.array_repeat(F.lit(0.0), width)), 1, width)

    residuals = F.transform(_upto(width - 1, 0), lambda k: _dot(f["pi"], F.transform(F.slice("tail", k + 1, LAGS + 1), lambda w: w - F.col("mean"))))
    return best.select(
        SERIES, F.lit("arima").alias("model"), "fit_end",
        F.when(f.isNotNull(), F.create_map(
            F.lit("order"), F.array(f["p"].cast("double"), F.col("d").cast("double"), f["q"].cast("double")),
            F.lit("const"), F.array(F.col("mean") * (1 - _total(f["ar"]))),
            F.lit("ar"), padded(f["ar"]), F.lit("ma"), padded(f["ma"]),
            F.lit("sigma2"), F.array(f["v"] * F.col("n") / (F.col("n") - f["free"])), F.lit("aic"), F.array(f["aic"]),
            F.lit("w"), padded(F.slice("tail", 1, width)), F.lit("e"), padded(residuals),
            F.lit("last"), F.array(F.col("s.y"), F.coalesce(F.col("s.dy"), F.lit(0.0))),
        )).alias("params"),
        F.when(f.isNull(), F.when(F.col("n") < LEAST, "too few rows").otherwise("no stable order")).alias("error"))
