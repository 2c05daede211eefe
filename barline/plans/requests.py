"""Requests as rows: each asks for a run of the job, is claimed once, run, and answered by a result row.

The run key is a digest of the settings and the day, so the same request sent twice is one run.  A claim is a
file that only one driver can create; a claim without result that is older than ``STALE_HOURS`` belongs to
a driver that died and is taken over.  The result is written last, and tables of the job are upserts, so a
run that is made again after a failure leaves what one run leaves.  Settings are few small rows; they are
taken to the driver one at a time, since each starts a job of its own.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.text import parse_requests
from barline.operators.pairs import all_pairs
from barline.plans.run import RUN_SUMMARY, promoted_mode, run
from barline.schema import MODELS, SERIES
from barline.sources import publish
from barline.sources.layout import read_or_none
from barline.sources.tables import read_model_params

STALE_HOURS = 6.0
RESULT = f"run_key string, asked_mode string, {RUN_SUMMARY}"


def keyed_requests(requests: DataFrame, run_date: datetime.date, payload: str = "payload", at: str = "at") -> DataFrame:
    """(run_key, at, mode, tickers, model_names, benchmark): a row per different request, the earliest ``at`` counts.

    Names are upper-cased, sorted and taken once, so their order and case make no new request; an empty list is no list.  A
    null ``at`` comes first, requests of the same time go by their key.
    """
    def names(c: str, change=lambda x: x):
        kept = F.array_sort(F.array_distinct(F.transform(F.filter(c, lambda x: x.isNotNull()), change)))
        return F.when(F.size(kept) > 0, kept)

    parsed = parse_requests(requests.select(F.col(at).alias("at"), F.col(payload).alias("payload")))
    parsed = parsed.withColumns({"tickers": names("tickers", F.upper), "model_names": names("model_names")})
    settings = F.to_json(F.struct(F.lit(run_date.isoformat()).alias("day"), "mode", "tickers", "model_names", "benchmark"))
    return parsed.groupBy(F.sha2(settings, 256).alias("run_key"), "mode", "tickers", "model_names", "benchmark").agg(F.min("at").alias("at"))


def results(spark: SparkSession, workdir: str) -> DataFrame:
    """The answers given so far."""
    found = read_or_none(spark, f"{workdir}/run_results")
    return spark.createDataFrame([], RESULT) if found is None else found


def pending(spark: SparkSession, workdir: str, keyed: DataFrame) -> DataFrame:
    return keyed.join(results(spark, workdir).select("run_key"), "run_key", "left_anti")


def claim(spark: SparkSession, workdir: str, run_key: str, stale_hours: float = STALE_HOURS) -> bool:
    """Whether this driver may run the request: it created the claim, or took over one that is too old."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{workdir}/run_claims/{run_key}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    try:
        if files.createNewFile(path):
            return True
        age = datetime.datetime.now().timestamp() - files.getFileStatus(path).getModificationTime() / 1000
        return age > stale_hours * 3600 and files.delete(path, False) and files.createNewFile(path)
    except Exception as e:  # noqa: BLE001 - another driver was quicker
        if "FileNotFoundException" in str(e) or "FileAlreadyExists" in str(e):
            return False
        raise


def answer(
    spark: SparkSession, requests: DataFrame, bars: DataFrame, workdir: str, run_date: datetime.date,
    restore_from: str | None = None, stale_hours: float = STALE_HOURS, **settings,
) -> DataFrame:
    """Run every request that has no answer yet and is not claimed by another driver; returns their answers.

    A working folder without parameters is filled from the version that ``restore_from`` points to.  A request to forecast
    only becomes a full one where none of its pairs has parameters.  ``settings`` go to :func:`barline.plans.run.run`.
    """
    keyed = keyed_requests(requests, run_date)
    todo = pending(spark, workdir, keyed).orderBy("at", "run_key").toLocalIterator()
    for r in todo:
        if not claim(spark, workdir, r.run_key, stale_hours):
            continue
        if restore_from and read_model_params(spark, f"{workdir}/model_params") is None and publish.current(spark, restore_from):
            publish.restore_version(spark, restore_from, workdir)
        wanted = bars.select(SERIES).distinct()
        if r.tickers:
            wanted = wanted.where(F.col(SERIES).isin(r.tickers))
        models = r.model_names or MODELS
        mode = promoted_mode(spark, workdir, r.mode, all_pairs(wanted, models))
        summary = run(spark, bars, workdir, mode, series=r.tickers, models=models, with_benchmark=r.benchmark, run_date=run_date, **settings)
        answered = summary.select(F.lit(r.run_key).alias("run_key"), F.lit(r.mode).alias("asked_mode"), "*")
        answered.coalesce(1).write.mode("append").parquet(f"{workdir}/run_results")
    return results(spark, workdir).join(keyed.select("run_key"), "run_key", "left_semi")
