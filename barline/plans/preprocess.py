"""From raw bars to scaled, split features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from barline.operators.clean import clip_outliers, drop_duplicate_dates, drop_incomplete, fill_gaps
from barline.operators.features import engineer_features, filter_min_length
from barline.operators.split import fit_scaler, scale, split_dates, time_split
from barline.schema import CLIP_FACTOR, MIN_FEATURE_ROWS


@dataclass(frozen=True)
class Panel:
    """Lazy results of preprocessing: raw features, scaled features, scaler and split dates."""

    features: DataFrame
    scaled: DataFrame
    scaler: DataFrame
    split_dates: DataFrame


def clean(bars: DataFrame) -> DataFrame:
    """Unique dates, filled gaps, clipped closes."""
    return bars.transform(drop_duplicate_dates).transform(fill_gaps).transform(drop_incomplete).transform(clip_outliers, CLIP_FACTOR)


def split_features(bars: DataFrame, min_rows: int = MIN_FEATURE_ROWS) -> DataFrame:
    """Features of the series that are long enough, labelled train, val or test."""
    return (
        clean(bars)
        .transform(engineer_features)
        .transform(filter_min_length, min_rows)
        .transform(time_split)
    )


def preprocess(bars: DataFrame, min_rows: int = MIN_FEATURE_ROWS) -> Panel:
    """All steps.  Series that fail a step have no rows; the others are not affected.

    One exchange on the series and one sort serve every window from the gap filling to the scaling.
    """
    features = split_features(bars, min_rows)
    return Panel(features, scale(features), fit_scaler(features), split_dates(features))

