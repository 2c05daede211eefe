"""Validation and cleaning of raw bars."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.numeric import clip
from barline.schema import CLIP_FACTOR, DATE, HISTORY_YEARS, MIN_RAW_ROWS, OHLCV, SERIES, TARGET, by_date, by_series


def series_profile(bars: DataFrame) -> DataFrame:
    """Per series: rows, first and last date, share of missing closes in percent."""
    return bars.groupBy(SERIES).agg(
        F.count("*").alias("n_rows"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        (F.avg(F.col(TARGET).isNull().cast("double")) * 100).alias("null_pct"),
    )


def validate_series(bars: DataFrame, universe: DataFrame | None = None, min_rows: int = MIN_RAW_ROWS) -> DataFrame:
    """One verdict per series; the first failing check wins.

    With a universe, a series that has no row at all appears as ``empty``.  A column is missing for a
    series if the frame does not have it, or, but for the target, if the series has no value in it.
    """
    here = [c for c in OHLCV if c in bars.columns]
    stats = bars.groupBy(SERIES).agg(F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in here])
    if universe is not None:
        stats = universe.select(SERIES).join(stats, SERIES, "left")
    n = F.coalesce("n_rows", F.lit(0))
    filled = F.coalesce(f"n_{TARGET}", F.lit(0)) if TARGET in here else F.lit(0)
    missing = F.array_compact(F.array(*[
        F.when(F.lit(c not in here) | (F.col(f"n_{c}") == 0) if c in here and c != TARGET else F.lit(c not in here), c)
        for c in OHLCV
    ]))
    verdict = (
        F.when(n == 0, "empty")
        .when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", ")))
        .when(filled == 0, "target all null")
        .when(n < min_rows, "too few rows")
        .otherwise("ok")
    )
    return stats.select(
        SERIES,
        n.cast("bigint").alias("n_rows"),
        F.try_divide((n - filled) * 100.0, n).alias("nan_pct"),
        verdict.alias("verdict"),
    )


def keep_valid(bars: DataFrame, universe: DataFrame | None = None, min_rows: int = MIN_RAW_ROWS) -> DataFrame:
    """Rows of the series whose verdict is ``ok``."""
    ok = validate_series(bars, universe, min_rows).where(F.col("verdict") == "ok")
    return bars.join(ok.select(SERIES), SERIES, "left_semi")


def trailing_window(bars: DataFrame, as_of: datetime.date | Column, years: int = HISTORY_YEARS) -> DataFrame:
    """Rows of the last ``years`` x 365 days before ``as_of``, the day itself excluded."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return bars.where((F.col(DATE) >= F.date_sub(end, 365 * years)) & (F.col(DATE) < end))


def drop_duplicate_dates(bars: DataFrame, ordinal: str = "ingest_ordinal") -> DataFrame:
    """One row per (series, date): the one that came first by ``ordinal``, or where rows carry none the
    smallest one, value column by value column with NULL first.

    An aggregate whose buffers hold one row, so a date repeated without limit is reduced on the map
    side and no task ever sees all its copies.
    """
    values = [c for c in bars.columns if c not in (SERIES, DATE, ordinal)]
    if ordinal in bars.columns:
        return bars.groupBy(SERIES, DATE).agg(*[F.min_by(c, ordinal).alias(c) for c in values])
    return bars.groupBy(SERIES, DATE).agg(F.min(F.struct(*values)).alias("_row")).select(SERIES, DATE, "_row.*")


def fill_forward(c: str) -> Column:
    """Last non-null value up to this row."""
    return F.last(c, ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow))


def fill_backward(c: str) -> Column:
    """First non-null value of the series.

    After a forward fill only leading rows are still null, and for those the next value is the first
    one; the whole-series frame is evaluated once, a shrinking frame would be quadratic.
    """
    return F.first(c, ignorenulls=True).over(by_date().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def fill_gaps(bars: DataFrame) -> DataFrame:
    """Forward fill, then back fill, of every value column inside its series."""
    values = [c for c in bars.columns if c not in (SERIES, DATE)]
    return bars.select(SERIES, DATE, *[F.coalesce(fill_forward(c), fill_backward(c)).alias(c) for c in values])


def drop_incomplete(bars: DataFrame) -> DataFrame:
    return bars.na.drop(subset=OHLCV)


def _quartiles() -> Column:
    """Linear-interpolated quartiles of the close; exact, over at most one value per date."""
    return F.percentile(TARGET, F.array(F.lit(0.25), F.lit(0.75)))


def _bounds(q: Column, factor: float) -> tuple[Column, Column]:
    spread = q[1] - q[0]
    return q[0] - factor * spread, q[1] + factor * spread


def iqr_bounds(bars: DataFrame, factor: float = CLIP_FACTOR) -> DataFrame:
    """Per series: quartiles of the close, clip bounds, number of closes outside them."""
    q = F.col("_q")
    lo, hi = _bounds(q, factor)
    return (
        bars.select(SERIES, TARGET, _quartiles().over(by_series()).alias("_q"))
        .select(SERIES, TARGET, q[0].alias("q1"), q[1].alias("q3"), lo.alias("lo"), hi.alias("hi"))
        .groupBy(SERIES)
        .agg(
            *[F.first(c).alias(c) for c in ("q1", "q3", "lo", "hi")],
            F.count_if((F.col(TARGET) < F.col("lo")) | (F.col(TARGET) > F.col("hi"))).alias("n_outliers"),
        )
    )


def attach_bounds(bars: DataFrame, bounds: DataFrame) -> DataFrame:
    """Stored clip bounds to rows.  No hint: the side is one row per series and Spark checks its size."""
    return bars.join(bounds.select(SERIES, "lo", "hi"), SERIES)


def clip_outliers(bars: DataFrame, factor: float = CLIP_FACTOR, bounds: DataFrame | None = None) -> DataFrame:
    """Limit the close of each series to its bounds; other columns and the row count stay.

    Without stored bounds they come from a window over the same partitioning as the other steps, which
    saves the second pass and the join.
    """
    if bounds is not None:
        framed = attach_bounds(bars, bounds)
    else:
        lo, hi = _bounds(F.col("_q"), factor)
        framed = (
            bars.withColumn("_q", _quartiles().over(by_series()))
            .withColumns({"lo": lo, "hi": hi})
        )
    clipped = clip(F.col(TARGET), F.col("lo"), F.col("hi")).alias(TARGET)
    return framed.select(*[clipped if c == TARGET else F.col(c) for c in bars.columns])
