"""Helpers of the operators: stored tables, folds, and columns added to Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.sources.layout import shared_folder

#: What separates words: \x20 and \x09-\x0D, which is also what bytes.split() splits at.
SPACES = " \t\n\x0b\x0c\r"
BATCH_BYTES = 8 << 20  # of an Arrow batch


def bound_batches(spark: SparkSession) -> None:
    """Lets Arrow batches hold at most ``BATCH_BYTES``, unless the session was given a bound of its own.

    Spark's default of 64 MB is held several times, in the JVM and in each Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") == str(64 << 20):
        spark.conf.set(key, str(BATCH_BYTES))


#: Folders of the tables that were stored while a scope was open; None outside of scopes.
_scope: list[str] | None = None


@contextmanager
def scope():
    """Gives the list of the folders of all tables that are stored inside, for ``drop``."""
    global _scope
    before, _scope = _scope, []
    try:
        yield _scope
    finally:
        _scope = before


def drop(spark: SparkSession, folders: list[str]) -> None:
    """Deletes stored tables that nothing reads any more, and empties the list."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    while folders:
        path = files.Path(folders.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back, so a lost executor costs no earlier step.

    With ``release``, the shuffle files of the write are deleted as soon as it is done, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scope is not None:
        _scope.append(path)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(release or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; null for a null key."""
    return F.crc32(key.cast("string")) % parts


def hash_sample(df: DataFrame, rows: int, about: int, *keys: str) -> DataFrame:
    """Of ``df``, which has ``rows`` rows, about as many as ``about``, or all if there are fewer: those whose hash of the
    keys is a multiple of a number.  Nothing is sorted or gathered for it, and the same rows give the same sample."""
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(max(1, -(-rows // about)))) == 0)


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` that do not clash, whatever their case, with ``names``."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(names: list[str]) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def added(df: DataFrame, *fields: tuple[str, T.DataType]) -> tuple[DataFrame, T.StructType]:
    """``df`` without columns that clash with the fields, and its schema followed by the fields."""
    bound_batches(df.sparkSession)
    base = df.select(*quoted(without(df, *(n for n, _ in fields))))
    return base, T.StructType([*base.schema.fields, *(T.StructField(n, k) for n, k in fields)])


def masked(df: DataFrame, *needed: str):
    """The rows with every column under a name that clashes with nothing, but for ``text``, which stays and is carried
    once, and with copies of the ``needed`` columns; and what gives such rows their old columns back."""
    names = df.columns
    text = next(i for i, n in enumerate(names) if n.lower() == "text")
    hidden = ["text" if i == text else f"carried column {i}" for i in range(len(names))]
    wide = df.toDF(*hidden)
    at = {n.lower(): hidden[i] for i, n in enumerate(names)}
    wide = wide.select("*", *(F.col(f"`{at[n]}`").alias(n) for n in needed))

    def back(rows: DataFrame) -> DataFrame:
        return rows.select(*(F.col(f"`{h}`").alias(n) for h, n in zip(hidden, names)))

    return wide, back


def grown(batch: pa.RecordBatch, arrays: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    """The batch with further columns at its end."""
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])


def give_back() -> None:
    """Returns to the system what this process has freed but still holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def giving_back(run):
    """``run`` over Arrow batches, with ``give_back`` at the end of the task.

    Spark keeps Python workers for later tasks, those of other stages too, so what they hold adds up with these.
    """
    @wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def pieces(batches, rows: int = 1000):
    """Arrow batches cut to at most ``rows`` rows, so that what Python holds of long texts stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def by_size(batches, column: str = "text", limit: int = 4_000_000):
    """The rows in Arrow batches whose texts have about ``limit`` bytes: smaller ones are put together, larger ones cut.

    A text that is longer by itself is a batch of its own.
    """
    held, total = [], 0
    for batch in batches:
        size = np.cumsum(np.concatenate([[0], pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)]))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(size, size[start] + limit - total, "right")) - 1)
            held.append(batch.slice(start, end - start))
            total += int(size[end] - size[start])
            start = end
            if total >= limit or start < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
