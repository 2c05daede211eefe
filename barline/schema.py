"""Column names, table schemas and the fixed settings shared by all operators.

Grain.  Every operator after :func:`barline.operators.clean.drop_duplicate_dates` works on rows that
are unique in ``(series, date)`` with ``date`` of type DATE.  A series therefore never holds more rows
than its calendar span has days (36 525 per century), however many raw rows stand behind it.  That
bound is what makes ``Window.partitionBy("series")`` safe; raw rows, which have no such bound, only
ever meet hash aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import types as T

SERIES = "series"
DATE = "date"
TARGET = "close"
OHLCV = ["open", "high", "low", "close", "volume"]

# Settings that determine the results.
UNIVERSE = ["AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "META", "NVDA", "JPM", "V", "JNJ"]
HISTORY_YEARS = 5
TRAIN_RATIO = 0.70
VAL_RATIO = 0.15
TEST_RATIO = 0.15
HORIZON = 30
CONFIDENCE = 0.95
ROLLING_WINDOWS = [5, 10, 20]
CLIP_FACTOR = 3.0
MIN_RAW_ROWS = 252
MIN_FEATURE_ROWS = 100
MAX_AGE_HOURS = 24
MAX_P = 5
MAX_Q = 5
MAX_D = 2
KPSS_CRITICAL = 0.463  # 5 % point of the KPSS level test (Kwiatkowski et al. 1992)
CHANGEPOINT_PRIOR = 0.05
SEASONALITY_PRIOR = 10.0
LOOK_BACK = 60
DROPOUT = 0.2
STOCHASTIC_PASSES = 50
SEED = 42
HISTORY_TAIL = 90
MODELS = ["arima", "prophet", "lstm"]
REPORT_ORDER = ["naive", "arima", "prophet", "lstm"]
MODES = ["full", "forecast_only", "single"]

# The feature columns in frame order.
FEATURES = [
    "close", "log_return",
    "rolling_mean_5", "rolling_std_5", "rolling_return_5",
    "rolling_mean_10", "rolling_std_10", "rolling_return_10",
    "rolling_mean_20", "rolling_std_20", "rolling_return_20",
    "high_low_spread", "volume_change",
]

BARS = T.StructType(
    [T.StructField(SERIES, T.StringType()), T.StructField(DATE, T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in OHLCV]
)

MODEL_PARAMS = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("fit_end", T.DateType()),
    T.StructField("params", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("error", T.StringType()),
])

FORECAST = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("lower", T.DoubleType()),
    T.StructField("upper", T.DoubleType()),
])

BENCHMARK = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("RMSE", T.DoubleType()),
    T.StructField("MAPE", T.DoubleType()),
    T.StructField("MAE", T.DoubleType()),
    T.StructField("rmse_vs_naive_pct", T.DoubleType()),
])

FORECAST_META = ["series", "generated_at", "last_known_price", "last_known_date"]


def by_series():
    """The whole series."""
    return Window.partitionBy(SERIES)


def by_date():
    """The series in date order; shared by all operators so that one exchange and sort serve them."""
    return Window.partitionBy(SERIES).orderBy(DATE)
