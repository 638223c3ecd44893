"""The registered corpus queries and the pipeline on the smallest tables."""

import __spark_entry__ as E
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(E.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = corpus_pipeline.cut(stage(spark, at, SF), f"test-{name}")
        assert path.columns == docs.columns
        if name == "ngram_join":
            assert path.count() == path.select("doc_id").distinct().count() < at.count()
        at = path
    packed = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert packed.where("piece = 0").count() == at.count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
