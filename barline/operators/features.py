"""Feature columns.  All windows share one partitioning and order, so they cost one exchange and sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.numeric import log_ratio, ratio
from barline.schema import DATE, FEATURES, MIN_FEATURE_ROWS, OHLCV, ROLLING_WINDOWS, SERIES, by_date, by_series


def log_return() -> Column:
    return log_ratio(F.col("close"), F.lag("close").over(by_date()))


def high_low_spread() -> Column:
    return ratio(F.col("high") - F.col("low"), F.col("close"))


def volume_change() -> Column:
    return log_ratio(F.col("volume"), F.lag("volume").over(by_date()))


def rolling(agg, c: str, w: int) -> Column:
    """``agg`` over the last ``w`` rows; NULL until all of them hold a value."""
    frame = by_date().rowsBetween(1 - w, 0)
    return F.when(F.count(c).over(frame) == w, agg(c).over(frame))


def drop_warmup(features: DataFrame) -> DataFrame:
    """Drop rows with any missing feature."""
    return features.na.drop()


def engineer_features(bars: DataFrame, drop: bool = True) -> DataFrame:
    """Bars plus the twelve derived columns, in frame order."""
    base = bars.withColumns({
        "log_return": log_return(),
        "high_low_spread": high_low_spread(),
        "volume_change": volume_change(),
    })
    rolled = base.withColumns({
        f"rolling_{name}_{w}": rolling(agg, c, w)
        for w in ROLLING_WINDOWS
        for name, agg, c in (("mean", F.avg, "close"), ("std", F.stddev_samp, "close"), ("return", F.sum, "log_return"))
    })
    derived = [c for c in FEATURES if c != "close"]
    extra = [c for c in bars.columns if c not in (SERIES, DATE, *OHLCV)]
    out = rolled.select(SERIES, DATE, *OHLCV, *extra, *derived)
    return drop_warmup(out) if drop else out


def feature_columns(df: DataFrame) -> list[str]:
    """Columns to be scaled: all but the keys and the raw open, high, low and volume, in frame order."""
    raw = {SERIES, DATE, "open", "high", "low", "volume", "split", "position", "raw_close"}
    return [c for c in df.columns if c not in raw]


def filter_min_length(features: DataFrame, min_rows: int = MIN_FEATURE_ROWS) -> DataFrame:
    """Drop series with fewer than ``min_rows`` rows."""
    return (
        features.withColumn("_n", F.count("*").over(by_series()))
        .where(F.col("_n") >= min_rows)
        .drop("_n")
    )


def null_audit(features: DataFrame) -> DataFrame:
    """Per series and split: number of missing feature values, and whether there is any."""
    nulls = sum((F.col(c).isNull().cast("bigint") for c in feature_columns(features)), F.lit(0).cast("bigint"))
    return (
        features.groupBy(SERIES, "split")
        .agg(F.sum(nulls).alias("n_null"))
        .withColumn("has_null", F.col("n_null") > 0)
    )
