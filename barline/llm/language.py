"""Language ID by rank-order profiles: the most frequent letter n-grams of a document against those of each language.

Texts are lower-cased; what is no letter or mark separates words; n-grams of one to three characters, with the
blanks around words, are counted over the whole text.  The distance of a document to a language is the sum, over the
document's leading n-grams, of how far each is out of place in the language's list, an absent one counting as far as
possible.  Null, empty and letterless texts get ``und`` with score 0.  Equal counts are ordered by code point and equal
distances by language name.  Rows without text or language teach nothing; without any profile all texts are ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import added, giving_back, grown, pieces

PROFILE = 400  # n-grams of a language
LEADING = 300  # n-grams of a document that are compared
UNKNOWN = "und"
_BREAKS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_MERGE_AT = 4_000_000  # n-gram entries a task holds before it adds up equal ones


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as integers of three 21-bit code points, ascending, and their counts."""
    if not text or not _LETTER.search(text):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    plain = " " + _BREAKS.sub(" ", text.lower()).strip() + " "
    one = np.frombuffer(plain.encode("utf-32-le"), np.uint32).astype(np.int64)
    two = (one[:-1] << 21) | one[1:]
    three = (two[:-1] << 21) | one[2:]
    inner = one[1:-1] != 32  # no n-gram reaches over a blank
    return np.unique(np.concatenate([one[one != 32], two, three[inner]]), return_counts=True)


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(count, first)


def _count(batches):
    held: dict[str, tuple[list, list]] = {}
    size = 0

    def flush():
        for lang, (codes, counts) in held.items():
            code, count = _summed(codes, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(count)], names=["lang", "gram", "n"])

    for batch in pieces(batches):
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            code, count = ngrams(text)
            if len(code):
                codes, counts = held.setdefault(lang, ([], []))
                codes.append(code)
                counts.append(count)
                size += len(code)
        if size > _MERGE_AT:
            held = {k: tuple([x] for x in _summed(*v)) for k, v in held.items()}
            size = sum(len(v[0][0]) for v in held.values())
            if size > _MERGE_AT // 2:  # still mostly distinct: hand over what is held
                yield from flush()
                held, size = {}, 0
    yield from flush()


def profiles(docs: DataFrame, profile: int = PROFILE) -> DataFrame:
    """(lang, gram, rank): the ``profile`` most frequent n-grams of each language over all given documents."""
    counted = (
        docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(giving_back(_count), "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile).select("lang", "gram", "rank")


def predictor(ranked: list, leading: int = LEADING, profile: int = PROFILE):
    """Text to (language, score).  The score is 1 minus the distance as a share of the largest possible one."""
    lists: dict[str, list] = {}
    for lang, gram, rank in ranked:
        lists.setdefault(lang, []).append((gram, rank))
    known = sorted(lists)
    sorted_lists = [tuple(np.array(x, np.int64) for x in zip(*sorted(lists[k]))) for k in known]

    def predict(text):
        code, count = ngrams(text)
        if not len(code) or not known:
            return UNKNOWN, 0.0
        top = code[np.argsort(-count, kind="stable")[:leading]]
        place = np.arange(1, len(top) + 1)
        best, choice = None, UNKNOWN
        for lang, (grams, ranks) in zip(known, sorted_lists):
            at = np.minimum(np.searchsorted(grams, top), len(grams) - 1)
            away = np.minimum(np.where(grams[at] == top, np.abs(ranks[at] - place), profile), profile).sum()
            if best is None or away < best:
                best, choice = away, lang
        return choice, 1.0 - float(best) / (profile * len(top))

    return predict


def identify(docs: DataFrame, ranked: DataFrame, leading: int = LEADING, profile: int = PROFILE) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row; columns of these names give way.

    The lists come to the driver: ``profile`` rows for each language, whatever the number of documents.
    """
    rows = [tuple(r) for r in ranked.select("lang", "gram", "rank").collect()]
    base, schema = added(docs, ("lang_pred", T.StringType()), ("score", T.DoubleType()))

    def run(batches):
        predict = predictor(rows, leading, profile)
        for batch in pieces(batches):
            found = [predict(t) for t in batch["text"].to_pylist()]
            yield grown(batch, [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                        ["lang_pred", "score"])

    return base.mapInArrow(giving_back(run), schema)


def learned(docs: DataFrame, train: Column, to_predict: DataFrame | None = None) -> DataFrame:
    """Learns from the rows where ``train`` holds and identifies all rows."""
    return identify(docs if to_predict is None else to_predict, profiles(docs.where(train)))
