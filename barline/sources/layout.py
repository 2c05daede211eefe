"""Storage layout of per-series tables.

Rows lie in hash buckets of the series, sorted by series inside a bucket.  A table of millions of
series is then a fixed number of files; reading one series prunes to its bucket by partition value and
to its row groups by statistics; writing some series replaces only the buckets they fall into.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barline.schema import DATE, SERIES

LAYOUT = ["buckets", "bucket"]
BUCKETS = 32  # of a new table; for large panels pass what makes a bucket a few files


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The table, or None when nothing is at the path.  A table that is there but cannot be read is an error."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or an empty one
            return None
        raise


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names for intermediate tables, shared by all executors.

    Unset in a local session, as in tests, it becomes a new temporary folder; on a cluster it has to be set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="barline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder.

    What follows reads the table: a lost executor costs no recomputation of the plan behind it, rows
    that would differ between two evaluations are fixed, and their real size guides the joins.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket(series, buckets):
    return F.pmod(F.xxhash64(series), buckets).cast("int")


def save_series(
    df: DataFrame, path: str, extra: tuple[str, ...] = (), buckets: int = BUCKETS, files: int = 1,
) -> None:
    """Insert or replace whole series; the other series of the table stay.

    ``extra`` names further partition columns, such as the model: a (series, extra) group is then the
    unit that is replaced.  ``buckets`` is a property that a table gets when it is created and keeps;
    ``files`` is into how many files, by a hash of the series, a bucket is written.  The rows are
    evaluated once.  Their buckets come to the driver, at most one row for each partition of the table,
    so that only these partitions of the old table are read.
    """
    spark = df.sparkSession
    old = read_or_none(spark, path)
    if old is not None:
        row = old.select("buckets").limit(1).collect()
        buckets = row[0][0] if row else buckets
    keys = [SERIES, *extra]
    rows = df.withColumns({"buckets": F.lit(buckets), "bucket": _bucket(F.col(SERIES), F.lit(buckets))})
    if old is not None:
        rows = cut_lineage(rows)
        touched = rows.select(*extra, "bucket").distinct().collect()
        in_touched = F.lit(False)
        for group in sorted({tuple(r[: len(extra)]) for r in touched}):
            own = F.col("bucket").isin([r["bucket"] for r in touched if tuple(r[: len(extra)]) == group])
            for name, value in zip(extra, group):
                own = own & (F.col(name) == F.lit(value))
            in_touched = in_touched | own
        new = rows.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
        same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))  # a row without a series is a key, too
        kept = old.where(in_touched).join(new, same, "left_anti")
        rows = kept.unionByName(rows, allowMissingColumns=True).select(rows.columns)
    order = [c for c in (*extra, "bucket", SERIES, DATE) if c in rows.columns]
    file = F.pmod(F.xxhash64(SERIES, F.lit("file")), F.lit(files))
    (
        rows.repartition(*extra, "bucket", file).sortWithinPartitions(*order)
        .write.partitionBy(*extra, *LAYOUT).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def load_series(spark: SparkSession, path: str, series: list[str] | None = None) -> DataFrame | None:
    """The table, or the chosen series of it; None when there is no table.  None among the series means rows without one."""
    table = read_or_none(spark, path)
    if table is None:
        return None
    if series is not None:
        in_bucket = F.lit(False)
        for s in series:
            in_bucket = in_bucket | (F.col("bucket") == _bucket(F.lit(s).cast("string"), F.col("buckets")))
        chosen = F.col(SERIES).isin([s for s in series if s is not None])
        table = table.where(in_bucket & (chosen | F.col(SERIES).isNull() if None in series else chosen))
    return table.drop(*LAYOUT)


def load_matching(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """The rows of the series in ``keys``, read from their buckets only; None when there is no table.

    The numbers of the buckets come to the driver, at most one for each bucket of the table.
    """
    table = read_or_none(spark, path)
    if table is None:
        return None
    row = table.select("buckets").limit(1).collect()
    if not row:
        return table.drop(*LAYOUT)
    touched = [r[0] for r in keys.select(_bucket(F.col(SERIES), F.lit(row[0][0]))).distinct().collect()]
    return table.where(F.col("bucket").isin(touched)).join(keys.select(SERIES), SERIES, "left_semi").drop(*LAYOUT)


def append_series(df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Adds rows to the buckets of their series; what is stored is neither read nor written again."""
    spark = df.sparkSession
    old = read_or_none(spark, path)
    row = [] if old is None else old.select("buckets").limit(1).collect()
    buckets = row[0][0] if row else buckets
    rows = df.withColumns({"buckets": F.lit(buckets), "bucket": _bucket(F.col(SERIES), F.lit(buckets))})
    rows.repartition("bucket").sortWithinPartitions("bucket", SERIES, DATE).write.partitionBy(*LAYOUT).mode("append").parquet(path)


def write_bucketed(df: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """The rows as a table that the planner knows to be dealt by series and sorted by date, in place of what is there.

    Windows, aggregates and joins on the series then need no exchange, in this and, over ``read_bucketed``, in later sessions.
    The number of buckets is that of the shuffle partitions unless given, so rows already dealt by series are written
    where they are, one file to a bucket.  For tables that are written as a whole; ``save_series`` replaces single series.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in (SERIES, DATE) if c in df.columns]
    df.repartition(buckets, SERIES).write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, SERIES).sortBy(
        *order).saveAsTable(_registered(path))
    row = spark.createDataFrame([(buckets, df.schema.json())], "buckets int, kind string")
    row.coalesce(1).write.mode("overwrite").json(f"{path}-layout")
    return spark.table(_registered(path))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of ``write_bucketed``; a session that does not know it yet is told its layout.  None when there is none."""
    told = read_or_none(spark, f"{path}-layout", "json")
    if told is None:
        return None
    name, row = _registered(path), told.first()
    if not spark.catalog.tableExists(name):
        kind = StructType.fromJson(json.loads(row["kind"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
        order = ", ".join(c for c in (SERIES, DATE) if c in kind.names)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({SERIES}) SORTED BY ({order}) "
                  f"INTO {row['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _registered(path: str) -> str:
    """The name under which the session's catalog knows the table at a path."""
    return "bars_" + hashlib.md5(path.encode()).hexdigest()


def cut_bucketed(df: DataFrame) -> DataFrame:
    """Like ``cut_lineage``, for rows that are next used by series."""
    return write_bucketed(df, f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}")
