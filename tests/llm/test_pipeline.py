from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tidelake.llm.shared import components, keep
from tidelake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            kept, given = out.count(), docs.count()
            assert 0.6 * given < kept <= given, name
            docs = out
    assert {"doc_id", "sample", "ids"} <= set(out.columns) and out.select("doc_id").distinct().count() == kept


def test_stages_take_awkward_tables(spark):
    """Nulls in any column, repeated rows, columns with names that the operators use, a very long text, and no rows at all."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    names = [f.name for f in rows.schema]
    nulls = rows.limit(1).selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in rows.schema])
    long_ = rows.limit(1).withColumns({"doc_id": F.lit(10**9).cast("bigint"), "text": F.concat_ws(" ", F.array_repeat("text", 400))})
    more = rows.unionByName(rows.limit(5)).unionByName(nulls).unionByName(nulls).unionByName(long_)
    extra = {n: F.lit(i) for i, n in enumerate(("score", "lang_pred", "id", "t", "h", "row", "spans", "kept", "digest", "component_id", "slot"))}
    docs = more.withColumns(extra)
    for name, stage in corpus_pipeline.STAGES:
        out = keep(stage(spark, docs, SMALL), "awkward")
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes and out.columns == [*names, *extra], name
            assert out.count() > 0
            docs = out
    assert out.count() > 0


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 299)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(found[i] == 1 for i in range(1, 41)) and all(found[100 + i] == 100 for i in range(30))
    assert found[202] == 200 and found[300] == 299 and found.get(7) == 1
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
