"""Publication by versions: a manifest per version, and a pointer that is written last.

A root holds ``versions/<version>/<table>`` folders that are never written again, the table ``manifest`` (version, table,
folder, n_rows, digest) and the table ``pointer`` (sequence, version), to both of which rows are only added.  A version exists
from the moment its pointer row does; that row is one file, committed by one rename or one upload.  A publication that stops
before leaves folders that nothing refers to, and readers keep the version before.

Tables that a publication does not hold, and the series and models that it leaves out, are carried over: the
former by their old folder, without a copy.  ``digest`` does not depend on the order of rows or files: it is the sum, over the
rows, of the leading digits of their MD5.  Restoring checks rows and digest of each table before it writes anything of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.schema import SERIES
from barline.sources.layout import LAYOUT, cut_lineage, load_series, read_or_none, save_series
from barline.sources.tables import BY_SERIES, CSV_OPTIONS, PLAIN

MANIFEST = "version string, table string, folder string, n_rows long, digest string"
_DIGITS = 15  # of an MD5, that is 60 bits of each row


def _texts(df: DataFrame) -> list[Column]:
    """Every column as text, in the order of their names; an absent value differs from an empty text."""
    kinds = dict((f.name, f.dataType) for f in df.schema.fields)
    out = []
    for name in sorted(kinds):
        value = F.col(f"`{name}`")
        if isinstance(kinds[name], (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value))
        elif isinstance(kinds[name], T.TimestampType):
            value = F.unix_micros(value)  # the same in every time zone
        out.append(F.coalesce(value.cast("string"), F.lit("\\N")))
    return out


def contents(df: DataFrame) -> DataFrame:
    """One row: n_rows and digest.  Columns of the layout are no content."""
    rows = df.drop(*LAYOUT)
    leading = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *_texts(rows)).cast("binary")), 1, _DIGITS), 16, 10).cast("decimal(20,0)")
    return rows.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(leading), F.lit(0)).cast("string").alias("digest"))


def current(spark: SparkSession, root: str) -> str | None:
    """The version that readers see; None before the first."""
    pointers = read_or_none(spark, f"{root}/pointer")
    row = None if pointers is None else pointers.agg(F.max(F.struct("sequence", "version")).alias("p")).first()["p"]
    return None if row is None else row["version"]


def manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The tables of a version, or of the current one; no rows where there is none."""
    version = version or current(spark, root)
    rows = read_or_none(spark, f"{root}/manifest")
    if rows is None or version is None:
        return spark.createDataFrame([], MANIFEST)
    return rows.where(F.col("version") == version)


def read_published(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame | None:
    """A table of a version, or of the current one; None if the version does not have it."""
    row = manifest(spark, root, version).where(F.col("table") == table).first()
    if row is None:
        return None
    return load_series(spark, row["folder"]) if table in BY_SERIES else spark.read.parquet(row["folder"])


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table of a work folder in its own format."""
    if name in BY_SERIES:
        return load_series(spark, f"{root}/{name}")
    return read_or_none(spark, f"{root}/{name}", PLAIN[name], **(CSV_OPTIONS if PLAIN[name] == "csv" else {}))


def _wanted(rows: DataFrame, series: list[str] | None, models: list[str] | None) -> Column:
    """Which rows a publication of some series and models holds."""
    key = next((c for c in (SERIES, "ticker") if c in rows.columns), None)
    held = F.lit(True)
    if series is not None and key:
        held = held & F.col(key).isin(series)
    if models is not None and "model" in rows.columns:
        held = held & F.col("model").isin(models)
    return held


def publish_version(
    spark: SparkSession, src: str, dst: str, tables: list[str] | None = None,
    series: list[str] | None = None, models: list[str] | None = None,
) -> DataFrame:
    """Publishes stored tables as a new version and reports each: (table, status, error).

    Nothing is published when a table fails: readers keep the version before.  The names of tables are a fixed list.
    """
    before = {r["table"]: r for r in manifest(spark, dst).collect()}
    version, entries, results = uuid.uuid4().hex, [], []
    for name in [*BY_SERIES, *PLAIN]:
        old = before.get(name)
        try:
            rows = _stored(spark, src, name) if tables is None or name in tables else None
            if rows is None:
                if old is not None:
                    entries.append((version, name, old["folder"], old["n_rows"], old["digest"]))
                if tables is None or name in tables:
                    results.append((name, "absent", None))
                continue
            held = _wanted(rows, series, models)
            rows = rows.where(held)
            if old is not None and (series is not None or models is not None):
                rows = rows.unionByName(read_published(spark, dst, name).where(~F.coalesce(held, F.lit(False))), allowMissingColumns=True)
            rows = cut_lineage(rows)
            folder = f"{dst}/versions/{version}/{name}"
            if name in BY_SERIES:
                save_series(rows, folder, BY_SERIES[name])
            else:
                rows.write.parquet(folder)
            found = contents(rows).first()
            entries.append((version, name, folder, found["n_rows"], found["digest"]))
            results.append((name, "copied", None))
        except Exception as problem:  # reported; the version is not pointed to
            results.append((name, "failed", str(problem).splitlines()[0]))
    if not any(status == "failed" for _, status, _ in results):
        spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{dst}/manifest")
        point(spark, dst, version)
    return spark.createDataFrame(results, "table string, status string, error string")


def point(spark: SparkSession, root: str, version: str) -> None:
    """Makes a version the current one; also how an earlier one is brought back."""
    pointers = read_or_none(spark, f"{root}/pointer")
    last = -1 if pointers is None else pointers.agg(F.coalesce(F.max("sequence"), F.lit(-1))).first()[0]
    row = spark.createDataFrame([(last + 1, version)], "sequence long, version string")
    row.coalesce(1).write.mode("append").parquet(f"{root}/pointer")


def verified(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(table, n_rows, digest, intact): the manifest against what the folders hold now."""
    results = []
    for row in manifest(spark, root, version).collect():  # a row for each of a fixed list of tables
        try:
            now = contents(read_published(spark, root, row["table"], row["version"])).first()
            intact = (now["n_rows"], now["digest"]) == (row["n_rows"], row["digest"])
        except Exception:  # a folder that cannot be read is not intact
            intact = False
        results.append((row["table"], row["n_rows"], row["digest"], intact))
    return spark.createDataFrame(results, "table string, n_rows long, digest string, intact boolean")


def restore_version(spark: SparkSession, root: str, dst: str, version: str | None = None, tables: list[str] | None = None) -> DataFrame:
    """Writes the tables of a version into a work folder and reports each: ``restored`` or ``damaged``.

    A table that does not have the rows and the digest of the manifest is not written.
    """
    results = []
    for row in verified(spark, root, version).collect():
        name = row["table"]
        if tables is not None and name not in tables:
            continue
        if row["intact"]:
            rows = read_published(spark, root, name, version)
            if name in BY_SERIES:
                save_series(rows, f"{dst}/{name}", BY_SERIES[name])
            else:
                options = CSV_OPTIONS if PLAIN[name] == "csv" else {}
                rows.write.mode("overwrite").options(**options).format(PLAIN[name]).save(f"{dst}/{name}")
        results.append((name, "restored" if row["intact"] else "damaged"))
    return spark.createDataFrame(results, "table string, status string")
