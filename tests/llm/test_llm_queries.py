"""The operators' queries and the pipeline over the smallest given tables."""

import os

import duckdb
import pytest
from test_queries import TABLES, normalised

import corpus_pipeline
from tidemark.llm.queries import llm_oracles, llm_queries

SF = os.environ.get("TIDEMARK_TEST_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_agrees_with_its_sql(spark, con, name):
    df = llm_queries()[name](spark, SF)
    result = con.execute(llm_oracles()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normalised(df.columns, df.collect()) == normalised(columns, result.fetchall())


def test_near_duplicates_of_the_table(spark, con):
    from test_llm_operators import brute_classes

    rows = [(i, t, None) for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()]
    got = {r["doc_id"]: r["class_id"] for r in llm_queries()["op8_near_dedup"](spark, SF).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("name", ["op3_token_counts", "op4_quality_classifier", "op5_license_scan"])
def test_other_queries_cover_the_table(spark, con, name):
    n = con.execute("SELECT count(*) FROM documents").fetchall()[0][0]
    got = llm_queries()[name](spark, SF).collect()
    assert (sum(r["n_docs"] for r in got) if name.startswith("op3") else len(got)) == n


def test_planted_licence_lines_are_found(spark, con):
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "This work is licensed under the GNU General Public License, version 3.": "GPL", "All rights reserved.": "All-Rights-Reserved"}
    want = {}
    for i, text in con.execute("SELECT doc_id, text FROM documents").fetchall():
        want[i] = sorted({f for line, f in lines.items() if line in (text or "").split("\n")})
    got = {r["doc_id"]: r["licenses"] for r in llm_queries()["op5_license_scan"](spark, SF).collect()}
    assert got == want


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).cache()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        assert {r["doc_id"] for r in out.select("doc_id").collect()} <= ids
        docs = out
    assert set(columns) | {"shard"} <= set(docs.columns) and docs.count() > 0


def test_stages_keep_clean_documents(spark, con):
    good = {i for (i,) in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SF).select("doc_id").collect()}
    assert len(good - kept) <= 0.02 * len(good)
    firsts = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()}
    from test_llm_operators import brute_classes

    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    assert firsts == set(brute_classes(rows).values())
