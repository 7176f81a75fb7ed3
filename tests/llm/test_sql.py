"""The queries of the package that have SQL, beside it, on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from goldenlake.llm.sql import STATEMENTS

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", STATEMENTS)
def test_query_equals_sql(spark, name):
    duck = pytest.importorskip("duckdb").connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got, want = driver.queries()[name](spark, SF_DIR).toArrow(), duck.sql(STATEMENTS[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    rows = (sorted(map(repr, zip(*(t.column(c).to_pylist() for c in columns), strict=True))) for t in (got, want))
    assert next(rows) == next(rows)


def test_pipeline_runs_and_drops_bad_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        if name == "quality_classifier":
            ids = {r.doc_id for r in kept.select("doc_id").collect()}
            right = sum((i in ids) == (q == 1) for i, q in labels.items())
            assert right >= 0.9 * len(labels)
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
