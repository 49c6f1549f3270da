import re

import corpus_pipeline
from tallymark.llm import decontamination, secrets

SF = "/root/testdata/sf0.001"


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
            assert out.count() <= before, name
            ids = {r["doc_id"] for r in out.select("doc_id").collect()}
            assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = out.cache()
        before = docs.count()
    assert secrets.scan(docs).where("size(spans) > 0").count() == 0
    assert decontamination.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert docs.where("size(split(text, ' ')) < 10").count() == 0


def test_run_gives_the_last_stage(spark):
    mixed = corpus_pipeline.run(spark, SF)
    assert mixed.columns[-1] == "copy"
    per = mixed.groupBy("doc_id").count().collect()
    assert per and max(r["count"] for r in per) <= 3
    assert not any(re.search("AKIA[A-Z0-9]{16}", r["text"]) for r in mixed.select("text").collect())
