"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
from quayside.llm import common
from tests.conftest import SF_DIR


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == before
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 1024").count() == 0


def test_stages_on_no_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
