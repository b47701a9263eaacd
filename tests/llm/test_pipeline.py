import corpus_pipeline
import pytest
from pelagia.llm.queries import QUERIES, SQL
from workload.check import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    columns, before = docs.columns, docs.count()
    packed = corpus_pipeline.run(spark, SMALL)
    ids = packed.select("doc_id").distinct()
    assert 0 < ids.count() < before
    kept = docs.join(ids, "doc_id", "left_semi").select(columns)
    for name, stage in corpus_pipeline.STAGES[1:4]:  # what was kept passes again whole
        again = stage(spark, kept, SMALL)
        assert again.columns == columns and again.count() == kept.count(), name


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], SQL[name]).startswith("ok")
