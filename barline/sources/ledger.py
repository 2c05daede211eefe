"""Ledger of source files: which versions of which files have been taken in.

A file is named by its path; a version of it by size, modification time and the SHA-256 of its content.  Sizes and times are
compared for all files without reading any; only files for which one of them is new are read, and of those only
the ones whose content is new are changed.  The ledger is a table that is only added to, after the rows of the
files have been stored: a run that fails in between takes the same files in again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.sources.layout import cut_lineage, read_or_none

LEDGER = "path string, length long, modified timestamp, digest string"


@dataclass(frozen=True)
class Changes:
    """Files to take in, and all versions that the ledger does not know yet, touched ones included."""

    files: list[str]
    versions: DataFrame


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modified of every CSV file under a folder; no content is read."""
    files = read_or_none(spark, path, "binaryFile", pathGlobFilter="*.csv")
    if files is None:
        return spark.createDataFrame([], "path string, length long, modified timestamp")
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def changes(spark: SparkSession, path: str, ledger: str) -> Changes:
    """What is new under ``path`` against the ledger.

    The names of files whose size or time is new come to the driver, which lists them for the read.
    """
    known = read_or_none(spark, ledger)
    now = listed(spark, path)
    candidates = now if known is None else now.join(known, ["path", "length", "modified"], "left_anti")
    names = [r[0] for r in candidates.select("path").collect()]
    if not names:
        return Changes([], spark.createDataFrame([], LEDGER))
    read = spark.read.format("binaryFile").load(names).select(
        "path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("digest"))
    versions = cut_lineage(read)
    # the newest version of a path counts: content that was replaced and has come back is a change
    last = None if known is None else known.groupBy("path").agg(F.max_by("digest", "modified").alias("digest"))
    changed = versions if last is None else versions.join(last, ["path", "digest"], "left_anti")
    return Changes([r[0] for r in changed.select("path").collect()], versions)


def record(found: Changes, ledger: str) -> None:
    """Adds the versions to the ledger; to be called when the rows of the files are stored."""
    found.versions.write.mode("append").parquet(ledger)
