"""The stages one after the other, each against what it says it does."""

import os
import random

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from barline.llm import bpe, common, jaccard, quality
from barline.llm.common import store, table

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "ngram_jaccard_join", "mixing", "byte_bpe"]
    names = [q for q in queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())


def test_every_stage_takes_effect(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = store(stage(spark, docs, SF), name)
        assert after.columns == columns
        assert after.count() <= docs.count() and after.exceptAll(docs).isEmpty()
        if name == "quality_rules":
            assert after.count() == quality.judge(store(quality.measure(docs).drop("text"), "m")).where("kept").count()
        if name == "ngram_jaccard_join":
            assert after.count() == jaccard.joined(docs).select("class_id").distinct().count()
        docs = after
    assert 0 < docs.count() < before
    name, mix = corpus_pipeline.STAGES[3]
    mixed = store(mix(spark, docs, SF), name)
    assert mixed.columns == columns and mixed.select("doc_id").distinct().join(docs, "doc_id", "left_anti").isEmpty()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    found = corpus_pipeline.byte_bpe(spark, mixed, SF).collect()
    assert sorted(r["n_tokens"] for r in found) == sorted(len(library.encode_ordinary(r["text"])) for r in mixed.collect())


def test_only_the_tables_of_the_last_stage_stay(spark, tmp_path, monkeypatch):
    table(spark, SF, "documents").limit(60).write.parquet(f"file://{tmp_path}/documents.parquet")
    monkeypatch.setattr(common, "shared_folder", lambda spark: f"file://{tmp_path}/shared")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() > 0
    left = sorted(p.name.rsplit("-", 1)[0] for p in (tmp_path / "shared").iterdir())
    assert left == sorted(n for n, _ in corpus_pipeline.STAGES)


def test_run_on_empty_documents(spark, tmp_path):
    table(spark, SF, "documents").limit(0).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_workers_give_back_what_an_encoding_task_has_freed(spark):
    """A worker is kept for the stages that follow, so it may not hold on to the memory of a task that is done."""
    rng = random.Random(5)
    texts = [(" ".join(str(rng.randrange(10**9)) for _ in range(20_000)),) for _ in range(16)]
    rows = store(spark.createDataFrame(texts, "text string").repartition(1), "numbers")

    def held(batches):
        for batch in batches:
            with open("/proc/self/smaps_rollup") as lines:
                own = next(int(x.split()[1]) for x in lines if x.startswith("Pss_Anon"))
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([own // 1024])], names=["pid", "mb"])

    def workers():
        return {r["pid"]: r["mb"] for r in spark.range(0, 8, 1, 8).mapInArrow(held, "pid long, mb long").collect()}

    before = workers()
    bpe.encode(rows, corpus_pipeline.RANKS, public_tokenizers.PATTERN).agg(F.sum("n_tokens")).first()
    assert max(workers().values()) < max(before.values()) + 60
