"""A feature panel that new days are added to.

Four tables lie under a root, in buckets of the series: ``bars`` (unique raw bars, the first taken in stays), ``filled`` (gaps
filled), ``panel`` (clipped, with features) and ``state``, one row per series: the last date, the clip bounds, the
extremes of the close, and whether all raw rows are in ``filled``.

``update`` reads and writes only buckets with series of the incoming rows.  A series is continued when its new dates
come after the last one, no row of it had to be dropped, and its new clip bounds move none of its old closes.  Its new rows are
then filled from its last ``WARM`` rows, which is as far as a feature looks back, and appended; old rows are read for the
bounds, in two columns, and are not computed again.  Every other series (new, revised in the past, or with closes that the
bounds move) is built anew from its bars.  Both ways give what building the whole panel at once gives.

The series of an update are noted in ``pending`` before the first write and the note is emptied after the last one, so that
a run that fails between has its series built anew by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.operators.clean import clip_outliers, drop_duplicate_dates, drop_incomplete, fill_gaps, iqr_bounds
from barline.operators.features import drop_warmup, engineer_features
from barline.schema import CLIP_FACTOR, DATE, OHLCV, ROLLING_WINDOWS, SERIES, TARGET
from barline.sources import ledger as files
from barline.sources.bars import read_bars
from barline.sources.layout import BUCKETS, append_series, cut_lineage, load_matching, read_or_none, save_series

WARM = max(ROLLING_WINDOWS)  # rows before a row that its features depend on
_COLUMNS = [SERIES, DATE, *OHLCV]


def _state(bars: DataFrame, closes: DataFrame) -> DataFrame:
    """The state of every series from its raw rows and its filled closes."""
    raw = bars.groupBy(SERIES).agg(F.count("*").alias("n_raw"), F.max(DATE).alias("last_date"))
    kept = closes.groupBy(SERIES).agg(F.count("*").alias("n"), F.min(TARGET).alias("least"), F.max(TARGET).alias("most"))
    return raw.join(kept, SERIES, "left").join(iqr_bounds(closes).select(SERIES, "lo", "hi"), SERIES, "left").select(
        SERIES, "last_date", "lo", "hi", "least", "most", F.coalesce(F.col("n") == F.col("n_raw"), F.lit(False)).alias("complete"))


def _build(root: str, bars: DataFrame, buckets: int) -> None:
    """Stores filled rows, panel and state of whole series, in place of what is stored of them."""
    filled = cut_lineage(bars.transform(fill_gaps).transform(drop_incomplete))
    save_series(filled, f"{root}/filled", buckets=buckets)
    save_series(engineer_features(clip_outliers(filled)), f"{root}/panel", buckets=buckets)
    save_series(_state(bars, filled), f"{root}/state", buckets=buckets)


def _continued(spark: SparkSession, root: str, new: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Filled rows after the last date, and the state with them, of the series of ``new`` that can be continued."""
    first = new.groupBy(SERIES).agg(F.min(DATE).alias("first_new"))
    able = cut_lineage(state.join(first, SERIES).where("complete AND first_new > last_date"))
    old = load_matching(spark, f"{root}/filled", able)
    newest = Window.partitionBy(SERIES).orderBy(F.desc(DATE))
    tail = old.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= WARM).select(*_COLUMNS, F.lit(False).alias("is_new"))
    both = tail.unionByName(new.join(able, SERIES, "left_semi").select(*_COLUMNS, F.lit(True).alias("is_new")))
    marks = both.select(SERIES, DATE, "is_new")
    filled = cut_lineage(fill_gaps(both.drop("is_new")).join(marks, [SERIES, DATE]))  # a tail is complete, so nothing is filled backwards
    closes = old.select(SERIES, TARGET).unionByName(filled.where("is_new").select(SERIES, TARGET))
    dated = new.join(able, SERIES, "left_semi").select(SERIES, DATE)
    after = cut_lineage(_state(dated, closes).drop("complete"))
    was = able.select(SERIES, *(F.col(c).alias(f"old_{c}") for c in ("lo", "hi", "least", "most")))
    still = (((F.col("lo") == F.col("old_lo")) | (F.col("old_least") >= F.greatest("lo", "old_lo")))
             & ((F.col("hi") == F.col("old_hi")) | (F.col("old_most") <= F.least("hi", "old_hi"))))
    after = after.join(was, SERIES).where(still).select(*after.columns, F.lit(True).alias("complete"))
    return filled, after


def update(spark: SparkSession, root: str, incoming: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Takes raw bars in and returns what became of their series: (series, way), ``continued`` or ``built``.

    Rows on a date that the series has already are ignored, as the first one counts.  A series without a new row is left out.
    """
    def path(name: str) -> str:
        return f"{root}/{name}"

    unique = cut_lineage(drop_duplicate_dates(incoming).select(*_COLUMNS))
    given = unique.select(SERIES).distinct()
    pending = read_or_none(spark, path("pending"))
    failed = cut_lineage(given.limit(0) if pending is None else pending.select(SERIES))
    stored = load_matching(spark, path("bars"), given)
    new = unique if stored is None else cut_lineage(unique.join(stored.select(SERIES, DATE), [SERIES, DATE], "left_anti"))
    touched = cut_lineage(new.select(SERIES).union(failed).distinct())
    touched.write.mode("overwrite").parquet(path("pending"))
    append_series(new, path("bars"), buckets)

    state = load_matching(spark, path("state"), touched)
    continued = touched.limit(0)
    if state is not None:
        fit = touched.join(failed, SERIES, "left_anti")
        filled, after = _continued(spark, root, new.join(fit, SERIES, "left_semi"), state)
        after = cut_lineage(after)
        continued = after.select(SERIES)
        own = filled.join(after.select(SERIES, "lo", "hi"), SERIES, "left_semi")
        dated = own.where("is_new").select(SERIES, DATE)
        rows = own.drop("is_new")
        warm = engineer_features(clip_outliers(rows, CLIP_FACTOR, after), drop=False)
        append_series(drop_warmup(drop_incomplete(warm).join(dated, [SERIES, DATE], "left_semi")), path("panel"), buckets)
        append_series(own.where("is_new").drop("is_new"), path("filled"), buckets)
        save_series(after, path("state"), buckets=buckets)
    rest = cut_lineage(touched.join(continued, SERIES, "left_anti"))
    if not rest.isEmpty():
        _build(root, load_matching(spark, path("bars"), rest), buckets)
    ways = cut_lineage(continued.withColumn("way", F.lit("continued")).unionByName(rest.withColumn("way", F.lit("built"))))
    touched.limit(0).write.mode("overwrite").parquet(path("pending"))
    return ways


def update_from_files(spark: SparkSession, root: str, folder: str, buckets: int = BUCKETS) -> tuple[list[str], DataFrame]:
    """Takes the changed CSV files of a folder in; returns their names and what became of their series.

    Files that the ledger knows are not read; the ledger is written last.
    """
    found = files.changes(spark, folder, f"{root}/ledger")
    if found.files:
        ways = update(spark, root, read_bars(spark, found.files), buckets)
    else:
        ways = spark.createDataFrame([], "series string, way string")
    files.record(found, f"{root}/ledger")
    return found.files, ways
