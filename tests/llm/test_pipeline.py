"""The corpus pipeline end to end, and its guard in the entry module."""

import corpus_pipeline

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "mixing to target weights", "sharding"]
    names = {q.split("_")[0] for q in E.queries()}
    assert {f"op{i}" for i in range(1, 11)} | {"pipeline"} <= names


def test_pipeline_runs_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert out and {r.doc_id for r in out} < ids
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    assert len(toxic & {r.doc_id for r in out}) <= len(toxic) // 2
    assert len({(r.shard, r.slot) for r in out}) == len(out)
