"""Every corpus query against its SQL, on the smallest tables, and what its plan may hold."""

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import rows
from transitloom.llm.oracle import corpus_oracles
from transitloom.llm.queries import corpus_queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "conversations", "pages")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(corpus_oracles()))
def test_query_equals_sql(spark, duck, name):
    found = corpus_queries()[name](spark, SF)
    expected = duck.sql(corpus_oracles()[name])
    names = sorted(found.columns)
    assert names == sorted(expected.columns)
    places = [expected.columns.index(column) for column in names]
    theirs = sorted((tuple(row[k] for k in places) for row in expected.fetchall()), key=repr)
    assert rows(found, *names) == theirs


@pytest.mark.parametrize("name", ["op2_mix_sources", "op4_license_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = corpus_queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(slow in plan for slow in ("Python", "MapInArrow", "Pandas"))


@pytest.mark.parametrize("name", sorted(set(corpus_queries()) - set(corpus_oracles())))
def test_query_covers_its_table(spark, name):
    table = "pages" if name == "op10_html_extract" else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    found = corpus_queries()[name](spark, SF)
    assert rows(found, key) == rows(spark.read.parquet(f"{SF}/{table}.parquet"), key)


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        if name != "sharding":
            assert result.columns == docs.columns
        docs = spark.createDataFrame(result.collect(), result.schema)
        sizes.append(docs.count())
    assert docs.columns[-1] == "shard"
    assert sizes[1] >= sizes[2] >= sizes[3] and sizes[4] == sizes[5]
    whole = corpus_pipeline.run(spark, SF)
    assert rows(whole, "doc_id", "shard") == rows(docs, "doc_id", "shard")
