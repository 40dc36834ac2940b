"""Encoding and decoding in one pass over the documents."""

import corpus_pipeline
from martforge.llm import bpe

ROWS = [(1, "en", "a", "Hello  world, 12345 é中文 <|endoftext|> x"), (2, "de", "b", ""), (3, None, None, None), (3, "en", "a", "copy copy\n\tcopy"),
        (None, "en", "a", "don't 한국")]
SCHEMA = "doc_id long, lang string, source string, text string"


def test_round_trip_is_encode_then_decode(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    apart = bpe.decode(bpe.encode(docs).selectExpr("*", "ids as tokens"), ids="tokens").collect()
    once = bpe.round_trip(docs).select(*docs.columns, "ids", "decoded").collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(once, key=key) == sorted(apart, key=key)
    assert all(r["decoded"] == (r["text"] or "") for r in once)


def test_last_stage_holds_one_worker_a_task(spark):
    """Two Python steps in one stage keep two workers alive for each running task."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    plan = corpus_pipeline.token_ids(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
