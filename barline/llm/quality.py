"""Quality rules: robust multivariate outliers of text statistics, per language and source.

``measure`` counts over whole texts; ``judge`` transforms the counts to vectors, estimates centre and scatter of every
(lang, source) group by the minimum covariance determinant, and rejects vectors whose Mahalanobis distance is too large.

The estimate starts from medians and quartile ranges and takes concentration steps: distances of all rows, the nearest
``SHARE`` of each group, their mean and covariance, until no group's determinant falls.  A step is one aggregation by
group and distance bin, so a group of any size becomes a few hundred partial sums, and the nearest share is a prefix of
its bins.  Distances are finally scaled down where a group's median is above that of the chi-square distribution.
Variances have floors in every direction, without which a group that is constant in one statistic, or in a combination
of them, would reject any other value.

Groups below ``SMALL`` rows are pooled by language, and languages that remain below it with each other; if even that
pool is small, nothing is rejected by distance.  Null languages and sources are groups of their own.  Null texts count
as empty; texts without words fail the base rules.  Rows are judged one by one, so repeated rows get the same verdict.
"""

from __future__ import annotations

from itertools import count as counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import SPACES, added, giving_back, grown, masked, pieces, quoted, store, without

WINDOW = 8  # words of a window that may repeat
SYMBOLS = "#*$%&|<>"
SMALL = 50  # rows below which a group has no estimate of its own
SHARE = 0.75  # of a group's rows that the estimate rests on
STEPS = 4  # concentration steps at least
FALL = 1e-3  # of the logarithm of a determinant, below which it no longer falls
LIMIT = 29.88  # largest squared distance that is kept: the 99.99% point of the chi-square distribution of 7 statistics
#: Statistic, and the smallest standard deviation it is given.
FLOORS = {"log_words": 0.5, "log_word_chars": 0.1, "symbols": 0.06, "dup_lines": 0.08, "repeats": 0.1, "capitals": 0.06, "variety": 0.06}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_distinct"]
_D = len(FLOORS)
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
_MEDIAN = _D * (1 - 2 / (9 * _D)) ** 3  # of the chi-square distribution, by Wilson and Hilferty


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more.  Windows are compared by numbering pairs, pairs of pairs and so on."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    width = 1
    while width < window:
        if width > 1:
            code = np.unique(code, return_inverse=True)[1]
        code = code[:-width] * (len(code) + 1) + code[width:]
        width *= 2
    _, code, count = np.unique(code, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, np.int64)
    start = np.flatnonzero(count[code] > 1)
    edge[start] += 1
    np.subtract.at(edge, start + window, 1)
    return int((np.cumsum(edge) > 0).sum())


def counts(text: str | None) -> tuple:
    """The counts of one text, in the order of COUNTS."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words), len(text) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(words), len(lines),
        sum(text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), len(set(words)),
    )


def measure(docs: DataFrame) -> DataFrame:
    """Adds the counts to every row; columns of these names give way."""
    base, schema = added(docs, *((c, T.LongType()) for c in COUNTS))

    def run(batches):
        for batch in pieces(batches):
            found = list(zip(*(counts(t) for t in batch["text"].to_pylist()))) or [()] * len(COUNTS)
            yield grown(batch, [pa.array(x, pa.int64()) for x in found], COUNTS)

    return base.mapInArrow(giving_back(run), schema)


def vector() -> Column:
    """The transformed statistics as an array.  On a grid of 1/256, so that medians are sums over few distinct values."""
    def share(a, b):
        return F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))

    stats = [
        F.log1p("n_words"), F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))), share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_capitals", "word_chars"),
        F.log1p("n_distinct") / F.greatest(F.log1p("n_words"), F.lit(1.0)),
    ]
    return F.array(*(F.round(s * 256) / 256 for s in stats))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _distance(x: str, mean: str, inverse: str) -> Column:
    """Squared Mahalanobis distance; ``inverse`` is the upper triangle of the inverted covariance."""
    away = [F.col(x)[i] - F.col(mean)[i] for i in range(_D)]
    return sum((away[i] * away[j] * F.col(inverse)[p] * (1 if i == j else 2) for p, (i, j) in enumerate(_PAIRS)), F.lit(0.0))


def _floored(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variances and axes, in units of the floors (the last result), with variances of at least 1."""
    unit = np.outer(*[list(FLOORS.values())] * 2)
    variances, axes = np.linalg.eigh(covariance / unit)
    return np.maximum(variances, 1), axes, unit


def _invert(mean: np.ndarray, covariance: np.ndarray) -> tuple[list, list]:
    variances, axes, unit = _floored(covariance)
    inverse = (axes / variances) @ axes.T / unit
    return mean.tolist(), [float(inverse[i, j]) for i, j in _PAIRS]


def _size(covariance: np.ndarray) -> float:
    """Logarithm of the determinant, but for a constant."""
    return float(np.log(_floored(covariance)[0]).sum())


_FITTED = "group string, mean array<double>, inverse array<double>, size double"


def _from_quartiles(frames):
    for frame in frames:
        out = []
        for group, quartiles in zip(frame["group"], frame["q"]):
            low, mid, high = np.array([list(q) for q in quartiles]).T
            cov = np.diag(np.square((high - low) / 1.349))
            out.append((group, *_invert(mid, cov), _size(cov)))
        yield pd.DataFrame(out, columns=["group", "mean", "inverse", "size"])


def _from_sums(frames):
    for frame in frames:
        out = []
        for group, n, one, two in zip(frame["group"], frame["n"], frame["one"], frame["two"]):
            mean, cov = np.array(one) / n, np.zeros((_D, _D))
            for (i, j), s in zip(_PAIRS, two):
                cov[i, j] = cov[j, i] = s / n - mean[i] * mean[j]
            out.append((group, *_invert(mean, cov), _size(cov)))
        yield pd.DataFrame(out, columns=["group", "mean", "inverse", "size"])


def _bins(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """Counts and sums of the vectors by group and distance bin, with how many rows of the group lie in nearer bins."""
    d2 = rows.join(fitted, "group").select("group", "x", _distance("x", "mean", "inverse").alias("d2"))
    near = Window.partitionBy("group").orderBy("bin")
    summed = d2.groupBy("group", F.floor(F.log2(1 + F.greatest("d2", F.lit(0.0))) * 32).alias("bin")).agg(
        F.count("*").alias("n"), F.avg("d2").alias("d2"),
        F.array(*(F.sum(F.col("x")[i]) for i in range(_D))).alias("one"),
        F.array(*(F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in _PAIRS)).alias("two"))
    return summed.withColumn("before", F.sum("n").over(near) - F.col("n")).withColumn(
        "all", F.sum("n").over(Window.partitionBy("group")))


def fit(rows: DataFrame) -> DataFrame:
    """(group, mean, inverse, scale) of rows (group, x): the estimate of each group, and what brings distances to scale."""
    quartiles = rows.groupBy("group").agg(
        F.array(*(F.percentile(F.col("x")[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))) for i in range(_D))).alias("q"))
    fitted = store(quartiles.mapInPandas(_from_quartiles, _FITTED), "mcd")
    for step in counter(1):
        nearest = _bins(rows, fitted).where(F.col("before") < F.ceil(F.col("all") * SHARE)).groupBy("group").agg(
            F.sum("n").alias("n"), F.array(*(F.sum(F.col("one")[i]) for i in range(_D))).alias("one"),
            F.array(*(F.sum(F.col("two")[p]) for p in range(len(_PAIRS)))).alias("two"))
        after = nearest.mapInPandas(_from_sums, _FITTED)
        if step <= STEPS:
            fitted = store(after, "mcd")
            continue
        fell = F.col("after.size") < F.col("fitted.size") - FALL
        fitted = store(fitted.alias("fitted").join(after.alias("after"), "group").select(
            "group", *(F.when(fell, F.col(f"after.{c}")).otherwise(F.col(f"fitted.{c}")).alias(c) for c in ("mean", "inverse", "size")), fell.alias("fell")), "mcd")
        if fitted.where("fell").isEmpty():
            break
        fitted = fitted.drop("fell")
    half = _bins(rows, fitted).where(F.col("before") < F.ceil(F.col("all") / 2)).groupBy("group").agg(
        (_MEDIAN / F.greatest(F.max("d2"), F.lit(_MEDIAN))).alias("scale"))
    return store(fitted.select("group", "mean", "inverse").join(half, "group"), "mcd")


def grouped(rows: DataFrame) -> DataFrame:
    """Adds ``group``: language and source, pooled where there are too few rows; null where even the pool is small."""
    def key(c):
        return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))

    rows = rows.withColumns({"lang_key": key("lang"), "group": F.to_json(F.array(key("lang"), key("source")))})
    sizes = rows.groupBy("lang_key", "group").agg(F.count("*").alias("n"))
    small = F.col("n") < SMALL
    by_lang = Window.partitionBy("lang_key")
    sizes = sizes.withColumn("pool", F.sum(F.when(small, F.col("n"))).over(by_lang))
    sizes = sizes.withColumn("to", F.when(~small, F.col("group")).when(F.col("pool") >= SMALL, F.to_json(F.array("lang_key"))).otherwise("rest"))
    rest = sizes.agg(F.coalesce(F.sum(F.when(F.col("to") == "rest", F.col("n"))), F.lit(0)).alias("rest"))
    sizes = store(sizes.withColumn("rest", rest.scalar()).select(
        "group", F.when((F.col("to") != "rest") | (F.col("rest") >= SMALL), F.col("to")).alias("to")), "groups")
    return rows.join(sizes, "group").drop("lang_key", "group").withColumnRenamed("to", "group")


def judge(measured: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Adds ``distance`` (null without an estimate), ``base_failed`` and ``kept`` to measured rows.

    The rows are read several times, so give a stored table.  Columns of these names give way.
    """
    kept = without(measured, "distance", "base_failed", "kept")
    rows = grouped(measured.select(F.struct(*quoted(kept)).alias("doc"), "lang", "source", vector().alias("x")))
    fitted = fit(rows.where("group IS NOT NULL").select("group", "x"))
    distance = (_distance("x", "mean", "inverse") * F.col("scale")).alias("distance")
    far = F.col("distance").isNotNull() & (F.col("distance") > limit)
    return (
        rows.join(fitted, "group", "left").select("doc", distance).select("doc.*", "distance")
        .withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~far)
    )


def filtered(docs: DataFrame) -> DataFrame:
    """The documents that pass the base rules and lie within the distance, with their own columns."""
    whole, back = masked(docs, "lang", "source")
    return back(judge(store(measure(whole), "measured")).where("kept"))
