"""Bar files and bar tables."""

from __future__ import annotations

import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions.numeric import null_if_not_finite
from barline.schema import DATE, MAX_AGE_HOURS, OHLCV, SERIES
from barline.sources.layout import BUCKETS, load_series, read_or_none, save_series

_NAME = r"([^/]+)\.csv$"
LARGE = 1 << 27  # bytes; a century of bars of a series has about 3 million


def _series_of(path: Column) -> Column:
    """Series named by a file.  Paths are URI-escaped; a plus sign stands for itself."""
    return F.regexp_extract(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), _NAME, 1)


def _csv(spark: SparkSession, path: str | list[str], large: bool, **options) -> DataFrame:
    """Text of the CSV files below ``LARGE`` bytes, or of the others; the other files are not opened."""
    size = F.col("_metadata.file_size")
    return spark.read.text(path, pathGlobFilter="*.csv", **options).where(size >= LARGE if large else size < LARGE)


def _fields(line: Column) -> Column:
    """Fields of a CSV line; the quotes around a field are removed."""
    outside = F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)  # commas that an even number of quotes follows
    bare = F.transform(outside, lambda v: F.replace(F.regexp_replace(F.trim(v), '^"|"$', ""), F.lit('""'), F.lit('"')))
    return F.when(F.contains(line, F.lit('"')), bare).otherwise(F.split(line, ",", -1))


def _bar_columns(raw: DataFrame, of: dict[str, Column], series: Column) -> DataFrame:
    return raw.select(
        series.alias(SERIES), of[DATE].try_cast("date").alias(DATE),
        *[null_if_not_finite(of[c].try_cast("double") if c in of else F.lit(None).cast("double")).alias(c) for c in OHLCV],
        F.monotonically_increasing_id().alias("ingest_ordinal"))


def _whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Bars of the files that a task takes as one row: the first line tells where the columns of its file are."""
    text = F.regexp_replace("value", "^\ufeff", "")
    files = _csv(spark, path, large=False, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.filter(F.split(text, "\r\n|\r|\n"), lambda v: F.trim(v) != "").alias("lines"))
    header = F.transform(_fields(F.get("lines", F.lit(0))), lambda c: F.lower(F.trim(c)))
    files = files.withColumn("header", header).select(
        "file", "lines", *(F.array_position("header", c).cast("int").alias(f"at_{c}") for c in (DATE, *OHLCV))).where(F.col(f"at_{DATE}") > 0)
    rows = files.select("file", *(f"at_{c}" for c in (DATE, *OHLCV)), F.explode(F.slice("lines", 2, F.size("lines"))).alias("line"))
    rows = rows.withColumn("fields", _fields(F.col("line")))
    of = {c: F.get("fields", F.col(f"at_{c}") - 1) for c in (DATE, *OHLCV)}
    return _bar_columns(rows, of, _series_of(F.col("file")))


def _block_files(spark: SparkSession, path: str | list[str]) -> list[DataFrame]:
    """Bars of the files that are read in blocks by several tasks, one table for each header among them.

    A header is the line that has a field named date.  The names of these files come to the driver, which lists them for the read.
    """
    is_header = F.lower("value").rlike(r'(^|,)\s*"?date"?\s*(,|$)')
    found = _csv(spark, path, large=True).where(is_header).groupBy("value").agg(F.collect_set("_metadata.file_path").alias("files")).collect()
    parts = []
    for row in found:
        names = [c.strip().strip('"').lower() for c in row["value"].lstrip("\ufeff").split(",")]
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        of = {c: F.col(f"c{i}") for i, c in reversed(list(enumerate(names)))}
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(sorted(unquote(f) for f in row["files"]))
        parts.append(_bar_columns(raw, of, _series_of(F.col("_metadata.file_path"))))
    return parts


def read_bars(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    """Bars from one file per series (``AAPL.csv``) or from a bar table.

    Columns are matched by header name, whatever their case and order, file by file; a column that a
    file does not have is NULL for its series, and so is a value that is no number.  A file is read once, as a whole by one task, which
    takes the columns from its first line that is not blank; one of ``LARGE`` bytes or more is read in blocks.  A file
    without a date column has no rows.  ``ingest_ordinal`` keeps the file order, so that
    duplicates can be resolved to the first.
    """
    if fmt != "csv":
        return load_series(spark, path)
    return reduce(DataFrame.unionByName, [_whole_files(spark, path), *_block_files(spark, path)])


def read_panel(spark: SparkSession, path: str, universe: DataFrame, fmt: str = "csv") -> DataFrame:
    """Bars of the series of a universe in one scan; absent series are simply missing."""
    return read_bars(spark, path, fmt).join(universe.select(SERIES), SERIES, "left_semi")


def daily_bars(df: DataFrame, key: Column | str, ts: Column | str, value: Column | str, tiebreak: Column | str) -> DataFrame:
    """One bar per key and day from timed values; first and last of a day are taken by ``tiebreak``.

    All buffers have a fixed width, so this is a hash aggregate with map-side partial aggregation: what
    is shuffled is at most one row per key, day and input partition, also for a dominating key.
    """
    v = null_if_not_finite(F.col(value) if isinstance(value, str) else value)
    tie = F.col(tiebreak) if isinstance(tiebreak, str) else tiebreak
    named = df.select(
        (F.col(key) if isinstance(key, str) else key).alias(SERIES),
        F.to_date(ts).alias(DATE),
        v.alias("_v"),
        F.when(v.isNotNull(), tie).alias("_t"),  # a tick without a value opens and closes no day
    )
    return named.groupBy(SERIES, DATE).agg(
        F.min_by("_v", "_t").alias("open"),
        F.max("_v").alias("high"),
        F.min("_v").alias("low"),
        F.max_by("_v", "_t").alias("close"),
        F.count("*").cast("double").alias("volume"),
    )


def stale_series(
    spark: SparkSession, path: str, universe: DataFrame, as_of: datetime.datetime,
    max_age_hours: float = MAX_AGE_HOURS, force: bool = False, fmt: str = "csv",
) -> DataFrame:
    """Series to load again: those without data and those whose data is ``max_age_hours`` old or older."""
    wanted = universe.select(SERIES)
    if force:
        return wanted
    if fmt == "csv":
        files = read_or_none(spark, path, "binaryFile", pathGlobFilter="*.csv")
        loaded = None if files is None else files.select(
            _series_of(F.col("_metadata.file_path")).alias(SERIES), F.col("modificationTime").alias("loaded_at")
        )
    else:
        loaded = load_series(spark, path)
    if loaded is None:
        return wanted
    limit = as_of - datetime.timedelta(hours=max_age_hours)
    fresh = loaded.groupBy(SERIES).agg(F.max("loaded_at").alias("loaded_at")).where(F.col("loaded_at") > F.lit(limit))
    return wanted.join(fresh, SERIES, "left_anti")


def write_bars(df: DataFrame, path: str, loaded_at: Column | None = None, buckets: int = BUCKETS) -> None:
    """Store bars; given series replace their old rows, the others stay."""
    stamped = df.withColumn("loaded_at", loaded_at if loaded_at is not None else F.current_timestamp())
    save_series(stamped, path, buckets=buckets)
