"""SQL with the same meaning as the registered queries, put together from shared common table expressions."""

from __future__ import annotations

from statistics import NormalDist

from barline.operators.sequence import PENALTIES
from barline.schema import CONFIDENCE, DROPOUT, FEATURES, KPSS_CRITICAL, OHLCV, ROLLING_WINDOWS, SEED, TRAIN_RATIO, VAL_RATIO
from catalog.queries import AS_OF, BENCH_ORDER, FEATURE_PLACES, LONG_NATION, PAIR

Z = NormalDist().inv_cdf((1 + CONFIDENCE) / 2)
SPLITS = ("train", "val", "test")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def _bars(key: str, ts: str, value: str, tie: str, source: str, name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT {key} AS series, CAST({ts} AS DATE) AS date, arg_min({value}, {tie}) AS open, max({value}) AS high,
         min({value}) AS low, arg_max({value}, {tie}) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM {source} GROUP BY 1, 2)"""


ORDER_BARS = _bars("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey", "orders")
NATION_BARS = _bars(
    "n_name", "o_orderdate", "o_totalprice", "o_orderkey",
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
)
EVENT_BARS = _bars("event_type", "ts", "value", "event_id", "events")
EVENT_BARS_2 = _bars("event_type", "ts", "value", "event_id", "events", "event_bars")
DOUBLED_URGENT = ORDER_BARS.replace("bars AS", "plain AS") + """,
bars AS (SELECT p.* REPLACE (open * f AS open, high * f AS high, low * f AS low, close * f AS close)
  FROM (SELECT *, CASE WHEN series = '1-URGENT' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS f FROM plain) p)"""
RAW = """raw AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date, o_totalprice AS open,
         o_totalprice * 1.03::DOUBLE AS high, o_totalprice * 0.96::DOUBLE AS low,
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS close,
         CAST(o_custkey AS DOUBLE) AS volume, o_orderkey AS ordinal
  FROM orders)"""
UNIQUE = """uniq AS (
  SELECT * EXCLUDE (ordinal, k) FROM (
    SELECT *, row_number() OVER (PARTITION BY series, date ORDER BY ordinal) AS k FROM raw) WHERE k = 1)"""
FILLED = "filled AS (SELECT series, date, " + ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND "
    f"CURRENT ROW), first_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN CURRENT ROW AND "
    f"UNBOUNDED FOLLOWING)) AS {c}" for c in OHLCV
) + " FROM uniq)"
COMPLETE = "complete AS (SELECT * FROM filled WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in OHLCV) + ")"


def _clipped(source: str, factor: float, bounds: str | None = None) -> str:
    bounds_cte = f"""bounds AS (
  SELECT series, q1, q3, q1 - {factor}::DOUBLE * (q3 - q1) AS lo, q3 + {factor}::DOUBLE * (q3 - q1) AS hi
  FROM (SELECT series, quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.75) AS q3
        FROM {bounds or source} GROUP BY series))"""
    return f"""{bounds_cte},
clipped AS (SELECT b.* REPLACE (least(greatest(close, lo), hi) AS close) FROM {source} b JOIN bounds USING (series))"""


def _featured(source: str = "clipped") -> str:
    frames = ", ".join(
        f"w{w} AS (PARTITION BY series ORDER BY date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for w in ROLLING_WINDOWS
    )
    rolled = ", ".join(
        f"CASE WHEN count({c}) OVER w{w} = {w} THEN {f}({c}) OVER w{w} END AS rolling_{name}_{w}"
        for w in ROLLING_WINDOWS
        for name, f, c in (("mean", "avg", "close"), ("std", "stddev_samp", "close"), ("return", "sum", "log_return"))
    )
    return f"""base AS (
  SELECT *, ln(nullif(close, 0) / nullif(lag(close) OVER o, 0)) AS log_return, (high - low) / nullif(close, 0) AS high_low_spread,
         ln(nullif(volume, 0) / nullif(lag(volume) OVER o, 0)) AS volume_change
  FROM {source} WINDOW o AS (PARTITION BY series ORDER BY date)),
feats AS (SELECT *, {rolled} FROM base WINDOW {frames}),
features AS (SELECT series, date, open, high, low, close, volume, {', '.join(c for c in FEATURES if c != 'close')}
  FROM feats WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)})"""


def _labelled(source: str = "features", name: str = "split", where: str = "WHERE n >= 100") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (n), CASE WHEN position < floor(n * {TRAIN_RATIO!r}::DOUBLE) THEN 'train'
    WHEN position < floor(n * {TRAIN_RATIO + VAL_RATIO!r}::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS position,
               count(*) OVER (PARTITION BY series) AS n FROM {source}) {where})"""


SCALER = "scaler AS (" + " UNION ALL ".join(
    f"SELECT series, '{c}' AS feature, min({c}) AS data_min, max({c}) AS data_max FROM split WHERE split = 'train' "
    "GROUP BY series" for c in FEATURES
) + """),
scaler_params AS (SELECT *, -data_min * scale AS "offset" FROM (
  SELECT *, CASE WHEN data_max = data_min THEN 1.0 ELSE 1.0 / (data_max - data_min) END AS scale FROM scaler))"""

SCALED = "limits AS (SELECT series, " + ", ".join(
    f"min({c}) AS lo_{c}, CASE WHEN max({c}) = min({c}) THEN 1.0 ELSE 1.0 / (max({c}) - min({c})) END AS f_{c}" for c in FEATURES
) + " FROM split WHERE split = 'train' GROUP BY series),\nscaled AS (SELECT s.* REPLACE (" + ", ".join(
    f"{c} * f_{c} - lo_{c} * f_{c} AS {c}" for c in FEATURES
) + "), s.close AS raw_close FROM split s JOIN limits USING (series))"

SPLIT = (ORDER_BARS, _clipped("bars", 3.0), _featured(), _labelled())
TO_SCALED = (*SPLIT, SCALED)

NAIVE = """naive AS (
  SELECT series, date, raw_close AS actual, coalesce(lag(raw_close) OVER (PARTITION BY series ORDER BY date), raw_close)
         AS predicted
  FROM scaled WHERE split = 'test')"""


def _scores(source: str, keys: str) -> str:
    return f"""SELECT {keys}, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
  avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape, avg(abs(actual - predicted)) AS mae
FROM {source} GROUP BY ALL"""


# AR(1) by the regression of each train value on the one before; its forecast in closed form.
AR1 = """lagged AS (
  SELECT *, lag(close) OVER (PARTITION BY series ORDER BY date) AS before FROM scaled WHERE split IN ('train', 'val')),
ar1 AS (
  SELECT series, regr_slope(close, before) AS phi, regr_intercept(close, before) AS const,
         (regr_syy(close, before) - regr_slope(close, before) * regr_sxy(close, before)) / (count(before) - 2) AS sigma2
  FROM lagged WHERE split = 'train' AND before IS NOT NULL GROUP BY series),
origin AS (SELECT series, max(date) AS fit_end, arg_max(close, date) AS y, arg_max(raw_close, date) AS price
           FROM scaled WHERE split IN ('train', 'val') GROUP BY series)"""


def _ar1_path(steps: str) -> str:
    return f"""path AS (
  SELECT series, step, const / (1 - phi) + pow(phi, step) * (y - const / (1 - phi)) AS forecast,
         sqrt(sigma2 * (1 - pow(phi, 2 * step)) / (1 - phi * phi)) * {Z!r}::DOUBLE AS half, fit_end, price
  FROM ar1 JOIN origin USING (series) JOIN {steps} USING (series))"""


def _autocov(order: str, orders: str) -> str:
    """Autocovariances at lags 0 to 16 of the differenced train values, the predictors of orders up to 16 from them by a
    recursion over the order, and the fit of smallest AIC among ``orders``; d from the table ``order`` (series, d)."""
    return f"""RECURSIVE_MARK ac_w AS (
  SELECT series, date, split, close AS y, d, row_number() OVER s AS t,
         CASE d WHEN 0 THEN close WHEN 1 THEN close - lag(close) OVER s ELSE close - 2 * lag(close) OVER s + lag(close, 2) OVER s END AS w
  FROM scaled JOIN ({order}) USING (series) WHERE split IN ('train', 'val') WINDOW s AS (PARTITION BY series ORDER BY date)),
ac_mean AS (SELECT series, any_value(d) AS d, count(w) AS n, CASE WHEN any_value(d) < 2 THEN avg(w) ELSE 0 END AS mean FROM ac_w WHERE split = 'train' GROUP BY series),
ac_x AS (SELECT series, t, w - mean AS x FROM ac_w JOIN ac_mean USING (series) WHERE split = 'train'),
ac_products AS (
  SELECT a.series, k, sum(a.x * b.x) AS s FROM ac_x a CROSS JOIN range(17) r(k) JOIN ac_x b ON a.series = b.series AND b.t = a.t - k GROUP BY a.series, k),
ac_gamma AS (SELECT series, list(s / n ORDER BY k) AS g FROM ac_products JOIN ac_mean USING (series) GROUP BY series),
dl AS (
  SELECT series, g, 0 AS k, []::DOUBLE[] AS phi, g[1] AS v FROM ac_gamma
  UNION ALL SELECT series, g, k + 1, list_concat([phi[j] - a * phi[k + 1 - j] FOR j IN range(1, k + 1)], [a]), v * (1 - a * a)
  FROM (SELECT *, (g[k + 2] - coalesce(list_sum([phi[j] * g[k + 2 - j] FOR j IN range(1, k + 1)]), 0)) / v AS a FROM dl WHERE k < 16)),
ac_psi AS (SELECT a.series, a.phi[1] AS psi1, a.phi[1] * b.phi[1] + a.phi[2] AS psi2 FROM dl a JOIN dl b ON a.series = b.series AND a.k = 16 AND b.k = 15),
ac_fits AS (
  SELECT series, k AS p, 0 AS q, coalesce(phi[1], 0) AS ar1, coalesce(phi[2], 0) AS ar2, 0::DOUBLE AS ma1 FROM dl WHERE k <= 2
  UNION ALL SELECT series, 0, 1, 0, 0, psi1 FROM ac_psi
  UNION ALL SELECT series, 1, 1, psi2 / psi1, 0, psi1 - psi2 / psi1 FROM ac_psi),
ac_scored AS (
  SELECT *, list_sum(flatten([[pi[i] * pi[j] * g[abs(i - j) + 1] FOR j IN range(1, 18)] FOR i IN range(1, 18)])) AS v,
         p + q + CASE WHEN d < 2 THEN 1 ELSE 0 END AS free
  FROM (SELECT *, list_concat([1::DOUBLE, -ar1 - ma1], [(-ar2 + ma1 * (ar1 + ma1)) * pow(-ma1, j) FOR j IN range(0, 15)]) AS pi
        FROM ac_fits JOIN ac_gamma USING (series) JOIN ac_mean USING (series))
  WHERE (p, q) IN ({orders}) AND abs(ar2) < 0.999 AND abs(ar1 / (1 - ar2)) < 0.999 AND abs(ma1) < 0.999),
ac_best AS (
  SELECT *, n * ln(v) + 2 * (free + 1) AS aic, v * n / (n - free) AS sigma2, mean * (1 - ar1 - ar2) AS const FROM ac_scored
  QUALIFY row_number() OVER (PARTITION BY series ORDER BY n * ln(v) + 2 * (free + 1), p, q) = 1)"""


def _autocov_path(d: int) -> str:
    """Steps of the fit in ``ac_best`` for d of 0 or 1, from the last values and the last residual before the origin."""
    return f"""ac_last AS (
  SELECT w.series, arg_max(w.y, t) AS y, list(w.w ORDER BY t DESC) AS ws, list(w.w - mean ORDER BY t DESC) AS xs FROM ac_w w JOIN ac_mean USING (series) GROUP BY w.series),
ac_path AS (
  SELECT series, 0 AS step, ws[1] AS w1, ws[2] AS w2, list_sum([pi[i] * xs[i] FOR i IN range(1, 18)]) AS e, y,
         0::DOUBLE AS psi1, 0::DOUBLE AS psi2, 0::DOUBLE AS c, 0::DOUBLE AS var, const, ar1, ar2, ma1, sigma2, p, q FROM ac_last JOIN ac_best USING (series)
  UNION ALL SELECT series, step + 1, w, w1, 0, CASE WHEN {d} = 0 THEN w ELSE y + w END, psi, psi1, c + psi,
         var + CASE WHEN {d} = 0 THEN psi * psi ELSE (c + psi) * (c + psi) END, const, ar1, ar2, ma1, sigma2, p, q
  FROM (SELECT *, const + ar1 * w1 + ar2 * w2 + ma1 * e AS w,
               CASE step WHEN 0 THEN 1 WHEN 1 THEN ma1 ELSE 0 END + ar1 * psi1 + ar2 * psi2 AS psi FROM ac_path WHERE step < 30))"""


def _passes(passes: int, steps: int) -> str:
    """Passes under dropout of the regression with ruled weights over the last five rows of two features.  What stays is the
    32-bit finaliser of MurmurHash3 twice: of (key of series and pass, step), then of that and the input."""
    def mixed(source: str, value: str, name: str) -> str:
        return f"""(SELECT * EXCLUDE (u1, u2, u3), xor(u3, u3 >> 16) AS {name} FROM (
    SELECT *, (xor(u2, u2 >> 13) * 3266489909::UBIGINT) & 4294967295 AS u3 FROM (
    SELECT *, (xor(u1, u1 >> 16) * 2246822507::UBIGINT) & 4294967295 AS u2 FROM (
    SELECT *, (({value}) & 4294967295)::UBIGINT AS u1 FROM {source}))))"""
    keyed = f"""(SELECT series, pass, step, ('0x' || substr(md5(series || '|' || pass || '|{SEED}'), 1, 8))::UBIGINT AS key
      FROM (SELECT DISTINCT series FROM scaled) CROSS JOIN range(1, {passes + 1}) r(pass) CROSS JOIN range(1, {steps + 1}) t(step))"""
    inputs = f"(SELECT * FROM {mixed(keyed, 'key + step::UBIGINT * 2654435769::UBIGINT', 'at_step')} CROSS JOIN range(10) i(j))"
    return f"""masks AS (
  SELECT series, pass, step, list(CASE WHEN h >= {DROPOUT} * 4294967296 // 1 THEN 1 / (1 - {DROPOUT}::DOUBLE) ELSE 0 END ORDER BY j) AS m
  FROM {mixed(inputs, 'at_step + j::UBIGINT * 2654435769::UBIGINT', 'h')} GROUP BY series, pass, step),
windows AS (
  SELECT series, flatten(list([close, rolling_std_5] ORDER BY date)) AS x FROM (
    SELECT series, date, close, rolling_std_5 FROM scaled WHERE split IN ('train', 'val')
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 5) GROUP BY series),
rolled AS (
  SELECT series, pass, 0 AS step, x, 0::DOUBLE AS value FROM windows CROSS JOIN range(1, {passes + 1}) r(pass)
  UNION ALL SELECT series, pass, step, list_concat(x[3:], [new, x[10]]), new FROM (
    SELECT series, pass, step + 1 AS step, x,
           x[9] + 0.01 + list_sum([(x[j] - 0.5) * m[j] * 0.3::DOUBLE * CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END / j FOR j IN range(1, 11)]) AS new
    FROM rolled JOIN (SELECT series, pass, step - 1 AS step, m FROM masks) USING (series, pass, step)))"""


def _pooled(look_back: int, cols: list[str], penalties: list[float]) -> str:
    """Ridge regression of the next step of the close on the last rows, pooled over the series: one Gauss-Jordan step per
    recursion for each penalty, then the penalty of smallest loss over the validation windows."""
    k = look_back * len(cols)
    x = [f"lag({c}, {n}) OVER s" for n in range(look_back, 0, -1) for c in cols]
    gram = ", ".join("[" + ", ".join(f"sum(v[{i}] * v[{j}])" for j in range(1, k + 2)) + "]" for i in range(1, k + 2))
    rates = ", ".join(f"{p!r}::DOUBLE" for p in penalties)
    return f"""RECURSIVE_MARK lags AS (
  SELECT split, [{", ".join(x)}, close - lag(close) OVER s]::DOUBLE[] AS v FROM scaled WHERE split IN ('train', 'val')
  WINDOW s AS (PARTITION BY series, split ORDER BY date) QUALIFY row_number() OVER s > {look_back}),
centre AS (SELECT [{", ".join(f"avg(v[{i}])" for i in range(1, k + 2))}] AS m FROM lags WHERE split = 'train'),
grams AS (
  SELECT split, count(*) AS n, [{gram}] AS g
  FROM (SELECT split, [v[i] - m[i] FOR i IN range(1, {k + 2})] AS v FROM lags CROSS JOIN centre) GROUP BY split),
solve AS (
  SELECT p, 1 AS k, [[g[i][j] + CASE WHEN i = j THEN p * n ELSE 0 END FOR j IN range(1, {k + 2})] FOR i IN range(1, {k + 1})] AS a
  FROM grams CROSS JOIN (SELECT unnest([{rates}]) AS p) WHERE split = 'train'
  UNION ALL SELECT p, k + 1, [[CASE WHEN i = k THEN a[k][j] / a[k][k] ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END
    FOR j IN range(1, {k + 2})] FOR i IN range(1, {k + 1})] FROM solve WHERE k <= {k}),
fits AS (SELECT p, [a[i][{k + 1}] FOR i IN range(1, {k + 1})] AS w FROM solve WHERE k = {k + 1}),
pooled AS (
  SELECT p, w, m[:{k}] AS mean, m[{k + 1}] AS const FROM (
    SELECT p, w, list_sum(flatten([[r[i] * g[i][j] * r[j] FOR j IN range(1, {k + 2})] FOR i IN range(1, {k + 2})])) AS loss
    FROM (SELECT p, w, list_concat([-c FOR c IN w], [1::DOUBLE]) AS r FROM fits) CROSS JOIN grams WHERE split = 'val') CROSS JOIN centre
  ORDER BY loss LIMIT 1),
windows AS (
  SELECT series, max(date) AS fit_end, flatten(list([{", ".join(cols)}] ORDER BY date)) AS x FROM (
    SELECT series, date, {", ".join(cols)} FROM scaled WHERE split IN ('train', 'val')
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= {look_back}) GROUP BY series)"""


POOLED = _pooled(5, PAIR, PENALTIES)
POOLED_ROWS = """, parts AS (
  SELECT NULL::VARCHAR AS series, NULL::DATE AS fit_end, 'coef' AS part, w AS v FROM pooled
  UNION ALL SELECT NULL, NULL, 'mean', mean FROM pooled UNION ALL SELECT NULL, NULL, 'const', [const] FROM pooled
  UNION ALL SELECT NULL, NULL, 'penalty', [p, 1] FROM pooled UNION ALL SELECT NULL, NULL, 'shape', [5, 2, 0]
  UNION ALL SELECT series, fit_end, 'window', x FROM windows UNION ALL SELECT series, fit_end, 'shape', [5, 2, 0] FROM windows)
SELECT series, fit_end, part, (i - 1)::INTEGER AS at, round(v[i], 6) AS value FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM parts)"""
POOLED_STEPS = """, rolled AS (
  SELECT series, 0 AS step, x, 0::DOUBLE AS value FROM windows
  UNION ALL SELECT series, step + 1, list_concat(x[3:], [new, x[10]]), new FROM (
    SELECT series, step, x, x[9] + const + list_sum([(x[j] - mean[j]) * w[j] FOR j IN range(1, 11)]) AS new
    FROM rolled CROSS JOIN pooled WHERE step < 20))
SELECT series, step::INTEGER AS step, round(value, 6) AS forecast FROM rolled WHERE step > 0"""
CSV_BARS = """csv_bars AS (SELECT '^' || series AS series, date, round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low,
  round(CASE WHEN series < '5' THEN close END, 4) AS close, volume FROM bars)"""
MEAN_STEP = """moved AS (SELECT *, close - lag(close) OVER (PARTITION BY series ORDER BY date) AS moved FROM scaled WHERE split IN ('train', 'val')),
mean_step AS (
  SELECT series, max(date) AS fit_end, arg_max(close, date) AS last, avg(moved) AS slope, stddev_pop(moved) AS spread FROM moved GROUP BY series)"""
AUTOCOV_OUT = """ SELECT series, fit_end, p::INTEGER AS p, d::INTEGER AS d, q::INTEGER AS q, round(const, 6) AS const, round(ar1, 6) AS ar1, round(ar2, 6) AS ar2,
  round(ma1, 6) AS ma1, round(sigma2, 8) AS sigma2, round(aic, 3) AS aic FROM ac_best JOIN (SELECT series, max(date) AS fit_end FROM ac_w GROUP BY series) USING (series)"""
AUTOCOV_STEPS = f""" SELECT series, step, round(y, 6) AS forecast, round(y - {Z!r}::DOUBLE * sqrt(sigma2 * var), 6) AS lower,
  round(y + {Z!r}::DOUBLE * sqrt(sigma2 * var), 6) AS upper FROM ac_path WHERE step > 0"""


def _recursive(sql: str) -> str:
    return sql.replace("RECURSIVE_MARK ", "").replace("WITH ", "WITH RECURSIVE ", 1)


STEPS_30 = "(SELECT series, unnest(generate_series(1, 30)) AS step FROM origin)"
TESTS = """tests AS (
  SELECT series, row_number() OVER (PARTITION BY series ORDER BY date) AS step, raw_close AS actual
  FROM scaled WHERE split = 'test')"""
MEANS = """drift AS (
  SELECT series, avg(close - before) AS slope FROM lagged WHERE split = 'train' AND before IS NOT NULL GROUP BY series),
level AS (SELECT series, avg(close) AS level FROM lagged WHERE split = 'train' GROUP BY series)"""
BENCH = f"""paths AS (
  SELECT series, step, 'ar1' AS model, forecast FROM path
  UNION ALL SELECT series, step, 'drift', y + step * slope FROM tests JOIN origin USING (series) JOIN drift USING (series)
  UNION ALL SELECT series, step, 'mean', level FROM tests JOIN level USING (series)),
pairs AS (
  SELECT series, model, actual, forecast / f_close + lo_close AS predicted
  FROM paths JOIN tests USING (series, step) JOIN limits USING (series)
  UNION ALL SELECT series, 'naive', actual, predicted FROM naive),
scores AS ({_scores('pairs', 'series, model')}),
bench AS (
  SELECT s.series, s.model, round_even(s.rmse, 4) AS rmse, round_even(s.mape, 4) AS mape, round_even(s.mae, 4) AS mae,
         CASE WHEN s.model = 'naive' THEN 0.0 ELSE round_even((s.rmse - n.rmse) / n.rmse * 100, 2) END AS rmse_vs_naive_pct
  FROM scores s JOIN scores n ON s.series = n.series AND n.model = 'naive')"""
TO_BENCH = (*TO_SCALED, NAIVE, AR1, TESTS, _ar1_path("tests"), MEANS, BENCH)
PER_MODEL = """per_model AS (
  SELECT model, avg(rmse) AS rmse, avg(mape) AS mape, avg(mae) AS mae FROM bench WHERE model <> 'naive' GROUP BY model)"""

# The n-th business day after a date, by counting weekdays.
BUSINESS = """business AS (
  SELECT anchor, business_day, row_number() OVER (PARTITION BY anchor ORDER BY business_day) AS step
  FROM (SELECT anchor, CAST(unnest(generate_series(anchor + INTERVAL 1 DAY, anchor + INTERVAL 60 DAY, INTERVAL 1 DAY)) AS DATE)
        AS business_day FROM anchors)
  WHERE isodow(business_day) < 6)"""
LONG = f"""anchors AS (SELECT DISTINCT fit_end AS anchor FROM origin),
{BUSINESS},
long AS (
  SELECT series, 'arima' AS model, p.step, business_day AS date, round_even(forecast / f_close + lo_close, 2) AS forecast,
         round_even((forecast - half) / f_close + lo_close, 2) AS lower,
         round_even((forecast + half) / f_close + lo_close, 2) AS upper,
         '2024-01-05T01:00:00Z' AS generated_at, round_even(price, 2) AS last_known_price, fit_end AS last_known_date
  FROM path p JOIN limits USING (series) JOIN business b ON b.anchor = p.fit_end AND b.step = p.step)"""
TO_LONG = (*TO_SCALED, AR1, _ar1_path(STEPS_30), LONG)
WIDE = """SELECT series, generated_at, last_known_price, last_known_date, date, forecast AS arima_forecast,
  lower AS arima_lower, upper AS arima_upper FROM long"""

KPSS = """train AS (SELECT series, date, close AS y FROM scaled WHERE split = 'train'),
cases AS (
  SELECT 'kpss_level' AS test, series, date, y AS v FROM train
  UNION ALL SELECT 'kpss_difference', series, date, d FROM (
    SELECT series, date, y - lag(y) OVER (PARTITION BY series ORDER BY date) AS d FROM train) WHERE d IS NOT NULL),
centred AS (
  SELECT test, series, row_number() OVER s AS pos, v - avg(v) OVER (PARTITION BY test, series) AS e,
         count(*) OVER (PARTITION BY test, series) AS n
  FROM cases WINDOW s AS (PARTITION BY test, series ORDER BY date)),
sums AS (SELECT *, sum(e) OVER (PARTITION BY test, series ORDER BY pos) AS cum, floor(3 * sqrt(n) / 13) AS l FROM centred),
gammas AS (
  SELECT a.test, a.series, sum((1 - (a.pos - b.pos) / (a.l + 1)) * a.e * b.e) AS g
  FROM sums a JOIN sums b ON a.test = b.test AND a.series = b.series AND b.pos >= a.pos - a.l AND b.pos < a.pos
  GROUP BY ALL),
kpss AS (
  SELECT test, series, sum(cum * cum) / (any_value(n) * any_value(n)) / (sum(e * e) / any_value(n) + 2 * any_value(g) / any_value(n)) AS stat
  FROM sums JOIN gammas USING (test, series) GROUP BY test, series),
kpss_wide AS (
  SELECT series, max(stat) FILTER (test = 'kpss_level') AS kpss_level,
         max(stat) FILTER (test = 'kpss_difference') AS kpss_difference FROM kpss GROUP BY series)"""

GRAM = ("1.0::DOUBLE", "high_low_spread", "volume_change", "close")
X_SUM = " + ".join(FEATURES)
NATION_LENGTH = f"""lengths AS (SELECT series, count(*) AS n_rows FROM features GROUP BY series),
long_nations AS (SELECT series FROM lengths WHERE n_rows >= {LONG_NATION})"""
NATION_FEATURES = (NATION_BARS, _featured("bars"), NATION_LENGTH)
REPORT = f"""counts AS (SELECT series, sum(volume) AS n FROM bars GROUP BY series),
wanted AS (SELECT n_name AS series, unnest(['arima', 'lstm']) AS model FROM nation),
status AS (
  SELECT w.series, w.model, CASE WHEN c.series IS NULL THEN 'missing' WHEN n < {LONG_NATION} THEN 'failed' ELSE 'ok' END AS status,
         CASE WHEN n < {LONG_NATION} THEN 'too few rows' END AS error
  FROM wanted w LEFT JOIN counts c ON c.series = w.series AND w.model = 'arima'),
report AS (
  SELECT series, model, status = 'ok' AS success, CASE WHEN model = 'arima' THEN 1.5 ELSE 2.25 END::DOUBLE AS duration_s,
         CASE WHEN status = 'ok' THEN '' ELSE coalesce(error, status) END AS error,
         CASE WHEN status = 'ok' THEN 'store/model=' || model ELSE '' END AS saved_path
  FROM status)"""


def _round(source: str, columns: list[str], places: dict[str, int] | int, plain: str = "") -> str:
    at = (lambda c: places) if isinstance(places, int) else (lambda c: places.get(c, 6))
    cols = ", ".join(f'round("{c}", {at(c)}) AS "{c}"' for c in columns)
    return f"SELECT {plain + ', ' if plain and cols else plain}{cols} FROM {source}"


def _verdict(source: str, rows: str = "count(*)") -> str:
    return f"""SELECT series, CAST({rows} AS BIGINT) AS n_rows,
  round((count(*) - count(close)) * 100.0::DOUBLE / count(*), 6) AS nan_pct,
  CASE WHEN count(close) = 0 THEN 'target all null' WHEN count(*) < 252 THEN 'too few rows' ELSE 'ok' END AS verdict
FROM {source} GROUP BY series"""


BAR_COLUMNS = _round("bars", OHLCV, 4, "series, date")
SCALED_PLACES = {**{c: 6 for c in FEATURES}, "open": 4, "high": 4, "low": 4, "volume": 4, "raw_close": 4}
SCALED_OUT = _round(
    "scaled", ["open", "high", "low", "volume", *FEATURES, "raw_close"], SCALED_PLACES, "series, date, position, split"
)
AR1_OUT = """SELECT series, 'arima' AS model, fit_end, round(const, 6) AS const, round(phi, 6) AS ar1,
  round(sigma2, 6) AS sigma2, round(y, 6) AS last_value FROM ar1 JOIN origin USING (series)"""
BENCH_OUT = _round("bench", ["rmse", "mape", "mae", "rmse_vs_naive_pct"], 3, "series, model")
DAY_TYPES = """days AS (SELECT date, list(DISTINCT series ORDER BY series) AS names FROM bars GROUP BY date)"""


def oracle_sql() -> dict[str, str]:
    known = {
        "daily_bars": _with(ORDER_BARS) + BAR_COLUMNS,
        "daily_bars_nation": _with(NATION_BARS) + BAR_COLUMNS,
        "daily_bars_events": _with(EVENT_BARS) + BAR_COLUMNS,
        "bars_table": _with(ORDER_BARS) + BAR_COLUMNS,
        "read_panel": _with(NATION_BARS) + BAR_COLUMNS + """ WHERE series IN (
  SELECT n_name FROM nation WHERE n_regionkey = (SELECT max(n_regionkey) FROM nation))""",
        "read_bars_csv": _with(ORDER_BARS, CSV_BARS) + "SELECT * FROM csv_bars",
        "read_panel_csv": _with(ORDER_BARS, CSV_BARS) + "SELECT * FROM csv_bars WHERE series > '^3'",
        "stale_series": _with(ORDER_BARS, EVENT_BARS_2) + """
SELECT series FROM (SELECT series, max(date) AS d FROM bars GROUP BY series
  UNION ALL SELECT DISTINCT series, NULL FROM event_bars)
WHERE d IS NULL OR d <= (SELECT max(date) FROM bars) - 1""",
        "forecast_table": _with(*TO_LONG) + WIDE + " WHERE series = '1-URGENT'",
        "all_forecasts": _with(*TO_LONG) + WIDE,
        "benchmark_file": _with(*TO_BENCH) + BENCH_OUT,
        "params_table": _with(*TO_SCALED, AR1) + AR1_OUT,
        "publish_tables": """SELECT "table", CASE WHEN "table" IN ('bars', 'scaler', 'model_params') THEN 'copied' ELSE 'absent'
  END AS status, CAST(NULL AS VARCHAR) AS error FROM (SELECT unnest(['bars', 'features', 'scaler', 'scaled', 'forecasts', 'model_params',
  'all_forecasts', 'benchmark', 'benchmark_summary', 'training_report', 'training_totals', 'rejected', 'run_summary']) AS "table")""",
        "publish_outcome": """SELECT CAST(3 AS BIGINT) AS copied, CAST(0 AS BIGINT) AS failed, true AS complete,
  true AS usable""",
        "artifact_manifest": """SELECT unnest(['bars', 'model_params']) AS "table", true AS has_files, true AS has_bytes""",
        "published_rows": _with(ORDER_BARS) + BAR_COLUMNS,
        "published_manifest": _with(DOUBLED_URGENT, """verdicts AS (
  SELECT series, count(*) AS n_rows, CASE WHEN count(*) < 252 THEN 'too few rows' ELSE 'ok' END AS verdict FROM bars GROUP BY series)""") + """
SELECT 'bars' AS "table", count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31), close, date, high,
  epoch_us(CAST(date AS TIMESTAMP)), low, open, series, volume)), 1, 15) AS BIGINT)) AS VARCHAR) AS digest, true AS intact FROM bars
UNION ALL SELECT 'rejected', count(*), CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31), n_rows, series, verdict)), 1, 15) AS BIGINT)) AS VARCHAR),
  true FROM verdicts""",
        "restored_rows": _with(DOUBLED_URGENT) + BAR_COLUMNS,
        "incremental_panel": _with(RAW, UNIQUE, FILLED, COMPLETE, _clipped("complete", 3.0), _featured()) + _round(
            "features", list(dict.fromkeys([*OHLCV, *FEATURES])), FEATURE_PLACES, "series, date"),
        "fresh_job": _with(NATION_BARS.replace("bars AS", "plain AS"), """bars AS (
  SELECT p.* REPLACE (open * f AS open, high * f AS high, low * f AS low, close * f AS close)
  FROM plain p JOIN (SELECT n_name AS series, CASE WHEN ascii(n_name) % 2 = 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS f FROM nation) USING (series))""") + BAR_COLUMNS,
        "upserted_bars": _with(NATION_BARS.replace("bars AS", "plain AS"), """bars AS (
  SELECT p.* REPLACE (open * f AS open, high * f AS high, low * f AS low, close * f AS close)
  FROM plain p JOIN (SELECT n_name AS series, CASE WHEN n_nationkey % 2 = 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS f FROM nation) USING (series))""") + BAR_COLUMNS,
        "dedup_without_ordinal": _with(RAW, """bars AS (
  SELECT * EXCLUDE (ordinal, k) FROM (SELECT *, row_number() OVER (PARTITION BY series, date ORDER BY open NULLS FIRST,
    high NULLS FIRST, low NULLS FIRST, close NULLS FIRST, volume NULLS FIRST) AS k FROM raw) WHERE k = 1)""") + BAR_COLUMNS,
        "leakage_cases": _with(NATION_BARS, """labelled AS (
  SELECT series, date, month(date) + length(series) % 3 AS m FROM bars WHERE year(date) < 1996 + ascii(series) % 3),
ends AS (
  SELECT series, max(date) FILTER (m <= 4) AS a, min(date) FILTER (m BETWEEN 5 AND 8) AS b,
         max(date) FILTER (m BETWEEN 5 AND 8) AS c, min(date) FILTER (m > 8) AS d FROM labelled GROUP BY series)""") + """
SELECT series, coalesce(a < b, true) AND coalesce(c < d, true) AS ordered FROM ends""",
        "benchmarkable_cases": _with(NATION_BARS) + """
SELECT n_name AS series FROM nation WHERE n_regionkey > 1
  AND n_name IN (SELECT series FROM bars GROUP BY series HAVING max(year(date)) >= 1995)""",
        "run_ledger": _with(ORDER_BARS, """usable AS (
  SELECT series, count(*) >= 252 AS ok, dense_rank() OVER (ORDER BY series) AS place FROM bars GROUP BY series),
asked(number, asked_mode, mode, lowest, highest) AS (VALUES (1, 'forecast_only', 'full', 1, 2), (3, 'single', 'single', 1, 99), (4, 'forecast_only', 'forecast_only', 2, 2))""") + """
SELECT '2024-01-05' AS run_id, asked_mode, mode, count(*) FILTER (ok) AS series_fetched,
  CASE WHEN mode = 'forecast_only' THEN 0 ELSE count(*) FILTER (ok) END AS series_trained, count(*) FILTER (ok) AS series_forecast,
  bool_and(ok) AS success FROM asked a JOIN usable u ON place BETWEEN lowest AND highest GROUP BY number, asked_mode, mode""",
        "job": _with(ORDER_BARS, "ok AS (SELECT count(*) FILTER (n >= 252) AS n, count(*) AS total FROM (SELECT count(*) AS n FROM bars GROUP BY series))") + """
SELECT 'full' AS mode, n AS series_fetched, n AS series_trained, n AS series_forecast, 3 * n AS models_trained,
  n = total AS success FROM ok""",
        "job_second_run": _with(NATION_BARS, """again AS (
  SELECT b.* FROM bars b JOIN nation ON n_name = series WHERE n_nationkey % 5 <> 0 OR day(date) <= 3),
ok AS (SELECT count(*) FILTER (n >= 252) AS n, count(*) AS total FROM (SELECT count(*) AS n FROM again GROUP BY series))""") + """
SELECT 'full' AS mode, n AS series_fetched, n AS series_trained, n AS series_forecast, n AS models_trained,
  n = total AS success, CASE WHEN n = total THEN 0 ELSE 1 END AS n_errors FROM ok""",
        "series_profile": _with(RAW) + """SELECT series, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
  round((count(*) - count(close)) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM raw GROUP BY series""",
        "validate_series_orders": _with(ORDER_BARS) + _verdict("bars"),
        "validate_series_events": _with(EVENT_BARS) + _verdict("bars"),
        "validate_series_raw": _with(RAW) + _verdict("raw"),
        "validate_series_universe": _with(ORDER_BARS) + """SELECT series, count(*) AS n_rows, 0.0::DOUBLE AS nan_pct,
  CASE WHEN count(*) < 252 THEN 'too few rows' ELSE 'ok' END AS verdict FROM bars GROUP BY series
UNION ALL SELECT DISTINCT event_type, CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), 'empty' FROM events""",
        "trailing_window": _with(ORDER_BARS) + BAR_COLUMNS
        + f" WHERE date >= DATE '{AS_OF}' - {365 * 3} AND date < DATE '{AS_OF}'",
        "drop_duplicate_dates": _with(RAW, UNIQUE) + _round("uniq", OHLCV, 4, "series, date"),
        "dedup_fill": _with(RAW, UNIQUE, FILLED, COMPLETE) + _round("complete", OHLCV, 4, "series, date"),
        "iqr_bounds": _with(ORDER_BARS, _clipped("bars", 0.25)) + """
SELECT series, round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, round(any_value(lo), 4) AS lo,
  round(any_value(hi), 4) AS hi, count(*) FILTER (close < lo OR close > hi) AS n_outliers
FROM bars JOIN bounds USING (series) GROUP BY series""",
        "clip_outliers": _with(ORDER_BARS, _clipped("bars", 0.25)) + _round("clipped", OHLCV, 4, "series, date"),
        "clip_stored_bounds": _with(
            RAW, UNIQUE, "whole AS (SELECT * FROM uniq WHERE close IS NOT NULL AND volume IS NOT NULL)", ORDER_BARS,
            _clipped("bars", 0.25, "whole")) + _round("clipped", OHLCV, 4, "series, date"),
        "engineer_features": _with(ORDER_BARS, _clipped("bars", 3.0), _featured()) + _round(
            "features", list(dict.fromkeys([*OHLCV, *FEATURES])), FEATURE_PLACES, "series, date"),
        "engineer_features_warmup": _with(NATION_BARS, _featured("bars")) + _round(
            "feats", list(dict.fromkeys([*OHLCV, *FEATURES])), FEATURE_PLACES, "series, date"),
        "filter_min_length": _with(*NATION_FEATURES) + f"SELECT * FROM lengths WHERE n_rows >= {LONG_NATION}",
        "feature_columns": _with(ORDER_BARS) + f"SELECT DISTINCT series, '{','.join(FEATURES)}' AS features FROM bars",
        "time_split": _with(*SPLIT) + "SELECT series, date, position, split FROM split",
        "train_plus_val": _with(*SPLIT) + """SELECT series, count(*) AS n_rows, max(date) AS last_date FROM split
WHERE split IN ('train', 'val') GROUP BY series""",
        "split_dates": _with(*SPLIT) + "SELECT series, " + ", ".join(
            f"min(date) FILTER (split = '{s}') AS {s}_start, max(date) FILTER (split = '{s}') AS {s}_end" for s in SPLITS
        ) + " FROM split GROUP BY series",
        "split_summary": _with(*SPLIT) + "SELECT series, " + ", ".join(
            f"count(*) FILTER (split = '{s}') AS {s}" for s in SPLITS
        ) + f", CAST({len(FEATURES)} AS INTEGER) AS n_features FROM split GROUP BY series",
        "null_audit": _with(ORDER_BARS, _featured("bars"), _labelled("feats", where="")) + "SELECT series, split, CAST(sum("
        + " + ".join(f"({c} IS NULL)::INT" for c in FEATURES) + """) AS BIGINT) AS n_null, n_null > 0 AS has_null
FROM split GROUP BY series, split""",
        "leakage_check": _with(ORDER_BARS) + "SELECT DISTINCT series, true AS ordered FROM bars",
        "fit_scaler": _with(*SPLIT, SCALER) + """SELECT series, feature, round(data_min, 2) AS data_min,
  round(data_max, 2) AS data_max, round(scale, 8) AS scale, round("offset", 6) AS "offset" FROM scaler_params""",
        "scale": _with(*TO_SCALED) + SCALED_OUT,
        "bucketed_scale": _with(*TO_SCALED) + SCALED_OUT,
        "scale_stored": _with(*TO_SCALED) + SCALED_OUT,
        "inverse_scale": _with(*SPLIT) + "SELECT series, date, round(close, 4) AS close FROM split",
        "preprocess": _with(RAW, UNIQUE, FILLED, COMPLETE, _clipped("complete", 3.0), _featured(), _labelled(), SCALED) + """
SELECT series, split, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, round(avg(close), 6) AS avg_close,
  round(avg(rolling_std_20), 6) AS avg_std, round(avg(volume_change), 6) AS avg_volume_change FROM scaled GROUP BY series, split""",
        "naive_forecast": _with(*TO_SCALED, NAIVE) + _round("naive", ["actual", "predicted"], 4, "series, date"),
        "naive_metrics": _with(*TO_SCALED, NAIVE, f"scores AS ({_scores('naive', 'series')})") + _round(
            "scores", ["rmse", "mape", "mae"], 4, "series, 'naive' AS model"),
        "error_metrics": _with("""pairs AS (
  SELECT o_orderpriority AS series, o_orderstatus AS model, o_totalprice AS actual, c_acctbal * 10 AS predicted
  FROM orders JOIN customer ON o_custkey = c_custkey)""", f"scores AS ({_scores('pairs', 'series, model')})") + _round(
            "scores", ["rmse", "mape", "mae"], 4, "series, model"),
        "align_forecast_actual": _with(*TO_SCALED, AR1, TESTS, _ar1_path("tests")) + """
SELECT series, 'arima' AS model, step, round(actual, 3) AS actual, round(forecast / f_close + lo_close, 3) AS predicted
FROM path JOIN tests USING (series, step) JOIN limits USING (series)""",
        "ar1_metrics": _with(*TO_BENCH) + _round("scores", ["rmse", "mape", "mae"], 3, "series, 'arima' AS model")
        + " WHERE model = 'ar1'",
        "benchmark_table": _with(*TO_BENCH) + BENCH_OUT,
        "aggregate_summary": _with(*TO_BENCH, PER_MODEL) + """
SELECT round(round_even((SELECT avg(rmse_vs_naive_pct) FROM bench WHERE model <> 'naive'), 2), 2) AS avg_rmse_reduction_pct,
  (SELECT model FROM per_model ORDER BY rmse, model LIMIT 1) AS best_model_by_rmse,
  (SELECT model FROM per_model ORDER BY mape, model LIMIT 1) AS best_model_by_mape,
  round((SELECT avg(rmse) FROM bench WHERE model = 'naive'), 2) AS naive_avg_rmse,
  (SELECT count(*) FROM per_model) AS n_models, (SELECT count(DISTINCT series) FROM bench) AS n_series""",
        "model_averages": _with(*TO_BENCH) + """SELECT model, round(round_even(avg(rmse), 4), 2) AS rmse,
  round(round_even(avg(mape), 4), 2) AS mape, round(round_even(avg(mae), 4), 2) AS mae,
  round(round_even(avg(rmse_vs_naive_pct), 4), 2) AS rmse_vs_naive_pct FROM bench WHERE model <> 'naive' GROUP BY model""",
        "kpi_summary": _with(*TO_BENCH, PER_MODEL) + """
SELECT printf('%+.1f%%', (SELECT avg(rmse_vs_naive_pct) FROM bench WHERE model <> 'naive')) AS avg_rmse_reduction,
  (SELECT upper(model) FROM per_model ORDER BY rmse, model LIMIT 1) AS best_model,
  (SELECT count(DISTINCT series) FROM bench) AS n_series""",
        "best_model": _with(*TO_BENCH, PER_MODEL) + "SELECT model FROM per_model ORDER BY rmse, model LIMIT 1",
        "pivot_metric": _with(*TO_BENCH) + "SELECT series, " + ", ".join(
            f"round(max(mae) FILTER (model = '{m}'), 3) AS \"{m}\"" for m in BENCH_ORDER
        ) + " FROM bench GROUP BY series",
        "ordered_report": _with(*TO_BENCH, PER_MODEL) + """
SELECT series, model, round(rmse, 3) AS rmse, round(mape, 3) AS mape, round(mae, 3) AS mae,
  CASE WHEN model = 'naive' THEN 'baseline' ELSE printf('%+.1f%%', rmse_vs_naive_pct) END AS vs_naive,
  CASE WHEN series = (SELECT min(series) FROM bench)
        AND model = (SELECT model FROM per_model ORDER BY rmse, model LIMIT 1) THEN 'best' ELSE '' END AS marker
FROM bench""",
        "format_benchmark": _with(*TO_BENCH) + """
SELECT series AS "Ticker", CASE WHEN model = 'naive' THEN 'Naive' ELSE upper(model) END AS "Model",
  printf('%.4f', rmse) AS "RMSE ($)", printf('%.2f%%', mape) AS "MAPE (%)", printf('%.4f', mae) AS "MAE ($)",
  CASE WHEN rmse_vs_naive_pct = 0 THEN 'baseline' ELSE printf('%+.1f%%', rmse_vs_naive_pct) END AS "vs Naive"
FROM bench WHERE series = '1-URGENT'""",
        "classify_change": _with(*TO_BENCH) + """
SELECT series, model, CASE WHEN rmse_vs_naive_pct = 0 THEN 'baseline' WHEN round_even(rmse_vs_naive_pct, 1) < -5 THEN 'strong'
  WHEN round_even(rmse_vs_naive_pct, 1) < 0 THEN 'good' WHEN round_even(rmse_vs_naive_pct, 1) > 5 THEN 'bad'
  ELSE 'marginal' END AS change_class FROM bench""",
        "filter_series_known": _with(*TO_BENCH) + BENCH_OUT + " WHERE series = '2-HIGH'",
        "filter_series_unknown": _with(*TO_BENCH) + BENCH_OUT,
        "benchmarkable_series": _with(ORDER_BARS) + "SELECT DISTINCT series FROM bars",
        "gram_sums": _with(*TO_SCALED) + "SELECT series, " + ", ".join(
            f"round(sum({a} * {b})::DOUBLE, 5) AS g{i}" for i, (a, b) in enumerate(
                (GRAM[j], GRAM[k]) for j in range(4) for k in range(j, 4))
        ) + " FROM scaled GROUP BY series",
        "difference_order": _with(*TO_SCALED, KPSS) + f"""
SELECT series, round(kpss_level, 6) AS kpss_level, round(kpss_difference, 6) AS kpss_difference,
  CASE WHEN kpss_level <= {KPSS_CRITICAL} THEN 0 WHEN kpss_difference <= {KPSS_CRITICAL} THEN 1 ELSE 2 END AS d FROM kpss_wide""",
        "ar1_fit": _with(*TO_SCALED, AR1) + AR1_OUT,
        "ar1_forecast": _with(*TO_SCALED, AR1, _ar1_path(STEPS_30)) + """
SELECT series, 'arima' AS model, step, round(forecast, 6) AS forecast, round(forecast - half, 6) AS lower,
  round(forecast + half, 6) AS upper FROM path""",
        "grouped_fit": _with(*TO_SCALED, MEAN_STEP) + """ SELECT series, 'mean_step' AS model, fit_end,
  CASE WHEN series NOT LIKE '3%' THEN round(last, 6) END AS last, CASE WHEN series NOT LIKE '3%' THEN round(slope, 6) END AS slope,
  CASE WHEN series NOT LIKE '3%' THEN round(spread, 6) END AS spread, CASE WHEN series LIKE '3%' THEN 'ValueError: not this one' END AS error FROM mean_step""",
        "grouped_forecast": _with(*TO_SCALED, MEAN_STEP) + """ SELECT series, 'mean_step' AS model, step::INTEGER AS step,
  round((last + step * slope) / f_close + lo_close, 3) AS forecast, round((last + step * slope - spread * sqrt(step)) / f_close + lo_close, 3) AS lower,
  round((last + step * slope + spread * sqrt(step)) / f_close + lo_close, 3) AS upper
FROM mean_step JOIN limits USING (series) CROSS JOIN range(1, 21) r(step) WHERE series NOT LIKE '3%'""",
        "autocov_fit": _recursive(_with(*TO_SCALED, KPSS, _autocov(f"""SELECT series, CASE WHEN kpss_level <= {KPSS_CRITICAL} THEN 0
          WHEN kpss_difference <= {KPSS_CRITICAL} THEN 1 ELSE 2 END AS d FROM kpss_wide""", "(0, 0), (0, 1), (1, 0), (1, 1)")) + AUTOCOV_OUT),
        "autocov_fit_210": _recursive(_with(*TO_SCALED, _autocov("SELECT DISTINCT series, 1 AS d FROM scaled", "(2, 0)")) + AUTOCOV_OUT),
        "autocov_forecast_101": _recursive(_with(*TO_SCALED, _autocov("SELECT DISTINCT series, 0 AS d FROM scaled", "(1, 1)"), _autocov_path(0)) + AUTOCOV_STEPS),
        "autocov_forecast_210": _recursive(_with(*TO_SCALED, _autocov("SELECT DISTINCT series, 1 AS d FROM scaled", "(2, 0)"), _autocov_path(1)) + AUTOCOV_STEPS),
        "to_ds_y": _with(ORDER_BARS) + "SELECT series, CAST(date AS TIMESTAMP) AS ds, round(close, 4) AS y FROM bars",
        "sequences": _with(*TO_SCALED) + f"""
SELECT series, split, date, round(y, 6) AS y, n_rows, round(x_sum, 4) AS x_sum, round(x_first, 6) AS x_first,
  round(x_last, 6) AS x_last
FROM (SELECT series, split, date, close AS y, count(*) OVER w AS n_rows, sum({X_SUM}) OVER w AS x_sum,
        first_value(close) OVER w AS x_first, last_value(close) OVER w AS x_last
      FROM scaled WINDOW w AS (PARTITION BY series, split ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))
WHERE n_rows = 60""",
        "last_sequence": _with(*TO_SCALED) + f"""
SELECT series, max(date) AS fit_end, count(*) AS n_rows, round(sum({X_SUM}), 4) AS x_sum,
  round(arg_min(close, date), 6) AS x_first, round(arg_max(close, date), 6) AS x_last
FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS k FROM scaled WHERE split IN ('train', 'val'))
WHERE k <= 60 GROUP BY series""",
        "sequence_length_guard": _with(NATION_BARS, _clipped("bars", 3.0), _featured(), _labelled()) + """
SELECT series, n_train, CASE WHEN n_train <= 320 THEN 'train split not longer than the look-back' END AS too_short
FROM (SELECT series, count(*) FILTER (split = 'train') AS n_train FROM split GROUP BY series)""",
        "fan_out_stochastic": _recursive(_with(*TO_SCALED, "RECURSIVE_MARK " + _passes(8, 12)) + """
SELECT series, pass::INTEGER AS pass, step::INTEGER AS step, round(value, 6) AS value FROM rolled WHERE step > 0"""),
        "sequence_fit_shared": _recursive(_with(*TO_SCALED, POOLED) + POOLED_ROWS),
        "sequence_forecast_shared": _recursive(_with(*TO_SCALED, POOLED) + POOLED_STEPS),
        "stochastic_masks": _recursive(_with(*TO_SCALED, "RECURSIVE_MARK " + _passes(50, 30)) + f"""
SELECT series, step::INTEGER AS step, round(avg(value), 6) AS forecast, round(avg(value) - {Z!r}::DOUBLE * stddev_pop(value), 6) AS lower,
  round(avg(value) + {Z!r}::DOUBLE * stddev_pop(value), 6) AS upper FROM rolled WHERE step > 0 GROUP BY series, step"""),
        "stochastic_interval": f"""
SELECT series, 'lstm' AS model, step, round(m, 5) AS forecast, round(m - {Z!r}::DOUBLE * s, 5) AS lower,
  round(m + {Z!r}::DOUBLE * s, 5) AS upper
FROM (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS step, avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s
      FROM orders GROUP BY ALL)""",
        "model_summary": _with(*TO_SCALED, AR1) + """
SELECT series, 'arima' AS model, 'ARIMA(' || series || '): order=(1,0,0), fitted to ' || fit_end AS summary FROM origin""",
        "business_dates": _with("anchors AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS anchor FROM orders)", BUSINESS) + """
SELECT anchor, step, business_day FROM business WHERE step <= 7""",
        "last_known": _with(*TO_SCALED) + """SELECT series, max(date) AS last_known_date,
  round_even(arg_max(raw_close, date), 2) AS last_known_price FROM scaled WHERE split = 'val' GROUP BY series""",
        "last_known_newest": _with(*TO_SCALED) + """SELECT series, max(date) AS last_known_date,
  round_even(arg_max(raw_close, date), 2) AS last_known_price FROM scaled GROUP BY series""",
        "forecast_long": _with(*TO_LONG) + "SELECT series, model, step, date, forecast, lower, upper FROM long",
        "forecast_wide": _with(*TO_LONG) + WIDE,
        "band_check": _with(*TO_LONG) + """SELECT series, model, count(*) AS n_steps,
  bool_and(lower <= forecast + 0.01 AND forecast <= upper + 0.01) AS ok FROM long GROUP BY series, model""",
        "clamp_bands": """SELECT c_name AS series, c_acctbal AS forecast, least(c_nationkey * 100.0::DOUBLE, c_acctbal) AS lower,
  greatest(c_nationkey * 200.0::DOUBLE, c_acctbal) AS upper FROM customer""",
        "combine_forecasts": _with(ORDER_BARS, EVENT_BARS_2) + """
SELECT series, date, round(close, 4) AS arima_forecast, CAST(NULL AS DOUBLE) AS lstm_forecast FROM bars
UNION ALL SELECT series, date, NULL, round(close, 4) FROM event_bars""",
        "select_models": _with(*TO_LONG) + """SELECT date, forecast AS arima_forecast, lower AS arima_lower, upper AS arima_upper
FROM long WHERE series = '1-URGENT'""",
        "forecast_text": _with(*TO_LONG) + """SELECT strftime(date, '%Y-%m-%d') AS date, printf('$%.2f', forecast) AS arima_forecast,
  printf('$%.2f', lower) AS arima_lower, printf('$%.2f', upper) AS arima_upper FROM long WHERE series = '2-HIGH'""",
        "last_updated": "SELECT '2024-01-05 01:00 UTC' AS last_updated",
        "history_tail": _with(ORDER_BARS) + BAR_COLUMNS
        + " QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC) <= 90",
        "preview": _with(NATION_BARS) + BAR_COLUMNS + " QUALIFY row_number() OVER (PARTITION BY series ORDER BY date) <= 5",
        "sort_by_date": _with(ORDER_BARS) + BAR_COLUMNS,
        "available_series": _with(*NATION_FEATURES) + """
SELECT n_name AS series, n_nationkey AS ordinal FROM nation WHERE n_name IN (SELECT series FROM long_nations)""",
        "failed_series": _with(*NATION_FEATURES) + """
SELECT n_name AS series FROM nation EXCEPT SELECT series FROM long_nations""",
        "distinct_series": "SELECT DISTINCT o_orderpriority AS series FROM orders",
        "untrained_pairs": _with(NATION_BARS, REPORT) + "SELECT series, model FROM status WHERE status <> 'ok'",
        "attach_models": _with(NATION_BARS, REPORT) + "SELECT series, model, status, error FROM status",
        "fitted_guard": _with(NATION_BARS, REPORT) + """
SELECT series, model, coalesce(error, 'not fitted') AS error FROM status WHERE status <> 'ok'""",
        "training_report": _with(NATION_BARS, REPORT) + "SELECT * FROM report",
        "training_totals": _with(NATION_BARS, REPORT) + """SELECT count(*) AS total, count(*) FILTER (success) AS success,
  count(*) FILTER (NOT success) AS failed, sum(duration_s) AS seconds FROM report""",
        "series_totals": _with(NATION_BARS, REPORT) + """SELECT series, count(*) FILTER (success) AS success,
  count(*) FILTER (NOT success) AS failed, coalesce(string_agg(model, ',' ORDER BY model) FILTER (NOT success), '') AS failed_models
FROM report GROUP BY series""",
        "run_summary": _with(*NATION_FEATURES, REPORT) + """
SELECT '2024-01-05' AS run_id, 'full' AS mode, (SELECT count(DISTINCT series) FROM bars) AS series_fetched,
  (SELECT count(DISTINCT series) FROM report WHERE success) AS series_trained,
  (SELECT count(*) FROM long_nations) AS series_forecast, (SELECT count(*) FROM report WHERE success) AS models_trained,
  0.0::DOUBLE AS duration_s, (SELECT count(*) FROM bars) > 0 AND (SELECT count(*) FROM long_nations) > 0 AS success,
  0.0::DOUBLE AS avg_rmse_reduction""",
        "first_errors": _with(EVENT_BARS, DAY_TYPES) + "SELECT date, array_to_string(names[1:3], '; ') AS shown FROM days",
        "parse_requests": """SELECT event_id,
  CASE event_type WHEN 'click' THEN 'forecast_only' WHEN 'view' THEN 'single' ELSE 'full' END AS mode,
  CASE WHEN event_type = 'click' THEN 'U' || user_id || ',V' END AS tickers,
  CASE WHEN event_type = 'view' THEN 'arima' END AS model_names, event_type <> 'view' AS benchmark FROM events""",
        "joined_upper": _with(EVENT_BARS, DAY_TYPES) + "SELECT date, upper(array_to_string(names, ' · ')) AS shown FROM days",
        "json_text": """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS json FROM nation""",
    }
    return {name: sql.replace(")SELECT", ")\nSELECT") for name, sql in known.items()}
