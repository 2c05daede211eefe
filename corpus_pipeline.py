"""Documents to training tokens: language, quality, near duplicates, mixing, tokens.

Every stage works on all rows that the one before kept.  A stage takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns of ``documents``.  ``run`` writes each result below the shared folder and reads it back.

``docs`` of a stage is what the stage before returned, written.  So a stage begins with deleting the tables that earlier
stages have stored on their way: a lost executor then goes back to the last written result, and the disk holds the tables of
one stage only.

Null and empty texts and those without letters go in the first stage, empty tables stay empty, and repeated rows stay until
the third, which keeps the row of the smallest doc_id of a group, null ids last.  Further columns are carried under
whatever name.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import bpe, jaccard, language, mixing, quality
from barline.llm.common import drop, fold, masked, scope, store, table
from barline.llm.queries import RANKS

#: Smallest share of the possible agreement with a language's profile; below it a text is in no language that was learned.
LEAST_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those far from every language.  Learns from the given rows but those of fold 2."""
    ranked = language.profiles(docs.where(fold(F.col("doc_id"), 4) != 2))
    whole, back = masked(docs)
    found = language.identify(whole, ranked)
    return back(found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or lie far from their language and source."""
    return quality.filtered(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates."""
    return jaccard.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and with the words, that the mix takes of them."""
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every document, with their number and digests."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


_left: list[str] = []  # tables of the stages before


def _alone(stage):
    """The stage, deleting first what the stages before have stored on their way to results that are written by now."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop(spark, _left)
        with scope() as stored:
            result = stage(spark, docs, sf_dir)
        _left.extend(stored)
        return result

    return run_stage


STAGES = [(name, _alone(stage)) for name, stage in (
    ("language_id", language_id), ("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing", mix_sources), ("byte_bpe", byte_bpe))]

#: No stage but the base rules is expressible in SQL, so the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
