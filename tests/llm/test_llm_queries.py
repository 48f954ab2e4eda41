"""Registered queries against their SQL, and what the native ones may not contain."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from terrametry.llm.queries import QUERIES, SQL
from tools.check import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    names, rows = spark_rows(df)
    assert rows
    if name in SQL:
        assert (names, rows) == sql_rows(connect(SF_DIR), SQL[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name.split("_")[0] in ("op1", "op6", "op9", "op13"):
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF_DIR)
        assert docs.columns == columns and docs.schema["n_chars"].dataType.typeName() == "long"
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert len(last) == before and all(r.n_tokens == len(r.ids) for r in last)
