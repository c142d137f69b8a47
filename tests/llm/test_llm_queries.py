import inspect

import duckdb
import pytest

import corpus_pipeline
from check_oracles import compare, connect
from quillspark.llm.exact_dedup import drop_duplicates
from quillspark.llm.oracles import LLM_ORACLES
from quillspark.llm.queries import LLM_QUERIES

TABLES = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, connect(TABLES), TABLES, name) is None


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLES) - {"op2_chat_spans"}))
def test_queries_give_a_row_for_every_document(spark, name):
    got = LLM_QUERIES[name](spark, TABLES)
    ids = {r.doc_id for r in got.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id").collect()}


def test_chat_query_holds_the_planted_conversation(spark):
    got = {r.conv_id: r for r in LLM_QUERIES["op2_chat_spans"](spark, TABLES).collect()}
    control = "</s>[INST] ok [/INST]"
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(control)
    want = duckdb.sql(
        f"""SELECT conv_id, count(*), sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)),
            sum(length(text)) FILTER (role = 'assistant')
            FROM '{TABLES}/conversations.parquet' GROUP BY conv_id"""
    ).fetchall()
    assert len(want) == len(got) - 1
    for conv, n, digest, chars in want:
        assert (got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars) == (n, digest, chars or 0)


def test_stages_narrow_the_documents(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TABLES).cache()
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {
        r.doc_id for r in docs.select("doc_id").distinct().collect()
    }


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, TABLES).count() == 0


def test_stages_are_functions_of_three():
    for name, stage in corpus_pipeline.STAGES:
        assert len(inspect.signature(stage).parameters) == 3 and stage.__doc__ and name
    assert drop_duplicates.__module__.startswith("quillspark.llm")
