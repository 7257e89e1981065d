import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm.common import cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(cut(stage(spark, out[-1], SF)))
    return out


def test_stages_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


def test_decisions_take_effect(stages):
    docs, good, apart, clean, mixed, tokens = stages
    assert docs.count() > good.count() > apart.count() == clean.count()
    assert good.join(docs, docs.columns, "left_anti").isEmpty()
    assert clean.agg(F.sum("n_chars")).first()[0] < apart.agg(F.sum("n_chars")).first()[0]
    assert mixed.count() == tokens.count() > 0
    assert tokens.where("not lossless").isEmpty()


def test_run_agrees_with_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["n_tokens"]) for r in df.select("doc_id", "n_tokens").collect())
    assert key(got) == key(stages[-1])


@pytest.mark.parametrize("empty", [True, False])
def test_stages_on_odd_documents(spark, empty):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [] if empty else [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words here", None, "t", 15), (3, "word " * 50_000, "en", None, None)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
    assert docs.isEmpty() == empty
