"""Time split and min-max scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.features import feature_columns
from barline.schema import DATE, SERIES, TARGET, TEST_RATIO, TRAIN_RATIO, VAL_RATIO, by_date, by_series

SPLITS = ["train", "val", "test"]


def position() -> Column:
    """Zero-based row position inside the series."""
    return F.row_number().over(by_date()) - 1


def time_split(
    features: DataFrame, train: float = TRAIN_RATIO, val: float = VAL_RATIO, test: float = TEST_RATIO
) -> DataFrame:
    """Label rows train, val or test by position; nothing is shuffled in time.

    The limits are floors of DOUBLE products, as in the usual ``int(n * ratio)``.
    """
    if abs(train + val + test - 1.0) >= 1e-9:
        raise ValueError("the split ratios must sum to 1")
    n = F.count("*").over(by_series())
    label = (
        F.when(F.col("position") < F.floor(F.col("_n") * F.lit(float(train))), "train")
        .when(F.col("position") < F.floor(F.col("_n") * F.lit(float(train + val))), "val")
        .otherwise("test")
    )
    return features.withColumns({"position": position(), "_n": n}).withColumn("split", label).drop("_n")


def train_plus_val(df: DataFrame) -> DataFrame:
    return df.where(F.col("split").isin("train", "val"))


def split_dates(features: DataFrame) -> DataFrame:
    """First and last date of each split, one row per series."""
    return features.groupBy(SERIES).agg(*[
        agg(F.when(F.col("split") == s, F.col(DATE))).alias(f"{s}_{name}")
        for s in SPLITS
        for name, agg in (("start", F.min), ("end", F.max))
    ])


def split_summary(features: DataFrame) -> DataFrame:
    """Rows per split and number of features, one row per series."""
    return features.groupBy(SERIES).agg(
        *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    ).withColumn("n_features", F.lit(len(feature_columns(features))))


def leakage_check(features: DataFrame) -> DataFrame:
    """Per series: does each split end before the next begins?"""
    d = split_dates(features)
    return d.select(
        SERIES,
        (F.coalesce(F.col("train_end") < F.col("val_start"), F.lit(True))
         & F.coalesce(F.col("val_end") < F.col("test_start"), F.lit(True))).alias("ordered"),
    )


def _scale_of(lo: Column, hi: Column) -> Column:
    return F.when(hi == lo, 1.0).otherwise(1.0 / F.nullif(hi - lo, F.lit(0.0)))


def fit_scaler(features: DataFrame) -> DataFrame:
    """Min-max parameters per (series, feature), fitted on the train rows only."""
    cols = feature_columns(features)
    train = features.where(F.col("split") == "train")
    wide = train.groupBy(SERIES).agg(
        *[agg(c).alias(f"{c}|{name}") for c in cols for name, agg in (("min", F.min), ("max", F.max))]
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}|min`").alias("data_min"), F.col(f"`{c}|max`").alias("data_max"))
        for c in cols
    ])
    lo, hi = F.col("data_min"), F.col("data_max")
    return (
        wide.select(SERIES, F.inline(pairs))
        .withColumn("scale", _scale_of(lo, hi))
        .withColumn("offset", -lo * F.col("scale"))
    )


def scaler_wide(params: DataFrame, features: list[str]) -> DataFrame:
    """One row per series with a (scale, offset) struct for each feature."""
    return params.groupBy(SERIES).pivot("feature", features).agg(F.first(F.struct("scale", "offset")))


def attach_scaler(df: DataFrame, params: DataFrame, feature: str = TARGET) -> DataFrame:
    """Parameters of one feature to rows.  No hint: the side is one row per series, sized by Spark."""
    one = params.where(F.col("feature") == feature).select(SERIES, "scale", "offset")
    return df.join(one, SERIES)


def scale(features: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """``x * scale + offset`` on every feature in all splits; raw columns stay, ``raw_close`` is added.

    Without stored parameters the train minimum and maximum come from windows over the series, in the
    same stage as the features.
    """
    cols = feature_columns(features)
    if params is None:
        train = F.col("split") == "train"
        fitted = features.withColumns({
            f"_{c}": F.struct(
                F.min(F.when(train, F.col(c))).over(by_series()).alias("lo"),
                F.max(F.when(train, F.col(c))).over(by_series()).alias("hi"),
            )
            for c in cols
        })

        def factor(c):
            return _scale_of(F.col(f"_{c}.lo"), F.col(f"_{c}.hi"))

        def shifted(c):
            return F.col(c) * factor(c) - F.col(f"_{c}.lo") * factor(c)
    else:
        wide = scaler_wide(params, cols)
        fitted = features.join(wide.select(SERIES, *[F.col(c).alias(f"_{c}") for c in cols]), SERIES)

        def shifted(c):
            return F.col(c) * F.col(f"_{c}.scale") + F.col(f"_{c}.offset")
    return fitted.select(
        *[shifted(c).alias(c) if c in cols else F.col(c) for c in features.columns],
        F.col(TARGET).alias("raw_close"),
    )


def inverse_scale(df: DataFrame, params: DataFrame, columns: list[str], feature: str = TARGET) -> DataFrame:
    """``(x - offset) / scale`` of one feature's parameters on the given columns."""
    back = attach_scaler(df, params, feature)
    return back.select(*[
        ((F.col(c) - F.col("offset")) / F.col("scale")).alias(c) if c in columns else F.col(c) for c in df.columns
    ])
