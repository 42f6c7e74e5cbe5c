import os

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm import pieces

SF = "/root/testdata/sf0.001"


def test_stages_pass_on_documents(spark, edges):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "source_mix", "token_ids"]
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, edges, SF).columns == edges.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_run_keeps_what_its_stages_keep(spark):
    rows = entry.queries()["pipeline"](spark, SF).collect()
    con = duckdb.connect()
    docs = dict(con.execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    texts = [docs[r.doc_id] for r in rows]
    assert rows and all(r.lossless for r in rows)
    assert len(set(texts)) == len({r.doc_id for r in rows})  # no copies of a text under two ids


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_top_k_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = sorted(map(tuple, entry.queries()["op10_block_topk"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == sorted(con.execute(entry.oracle_sql()["op10_block_topk"]).fetchall())


@pytest.fixture
def long_documents(spark):
    """48 documents of 250,000 characters in one partition. Spark's limit of a batch comes back after the test."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    yield spark.range(0, 48, 1, 1).selectExpr("id AS doc_id", "repeat(concat('text ', id, ' of many words '), 13000) AS text").selectExpr("doc_id", "left(text, 250000) AS text", "'en' AS lang", "'s' AS source", "250000L AS n_chars")
    spark.conf.set(key, before)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[1:]])
def test_a_stage_hands_python_no_large_batches(spark, long_documents, stage):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    stage(spark, long_documents.limit(2), SF)
    rows = long_documents.select("doc_id", "text").mapInArrow(sizes, "n long, bytes long").collect()
    # the row that reaches the limit is in
    assert sum(r.n for r in rows) == 48 and max(r.bytes for r in rows) <= corpus_pipeline.BATCH_BYTES + 300_000


def test_fewer_characters_at_once_give_the_same_ids(spark, long_documents, edges):
    model = public_tokenizers.path("piece_bpe_32k.model")
    for docs in (long_documents.limit(6), edges):
        want = pieces.round_trip(docs, model).collect()
        assert sorted(map(str, corpus_pipeline.encode(spark, docs, SF).collect())) == sorted(map(str, want))
