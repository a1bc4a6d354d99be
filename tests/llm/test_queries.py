"""Registered queries of the subpackage on the smallest tables, against SQL where there is any."""

import pytest

from terroir.llm import queries
from tests.comparing import same_as_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    if name in queries.SQL:
        same_as_sql(df, queries.SQL[name], FOLDER)
    else:
        n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
        assert df.count() == n


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.filter("not exact").count() == 0
    assert last.count() == docs.count()
