"""The pipeline and the registered queries."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from martforge.llm import queries
from tests.conftest import SF_ORACLE, SF_SMALL

#: whole small tables; op9's SQL lists every byte window, so it runs on the smallest
DIR = {"op9_suffix_dedup": SF_SMALL}


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    from tools.compare import compare, duck

    sf = DIR.get(name, SF_ORACLE)
    assert compare(spark, duck(sf), name, queries.QUERIES[name], queries.SQL[name], sf)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_returns_every_row(spark, name):
    table, each = {"op8": ("pages", 1), "op12": ("embeddings", 8)}.get(name.split("_")[0], ("documents", 1))
    assert queries.QUERIES[name](spark, SF_SMALL).count() == each * spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


def test_stages_against_brute_force(spark, docs, rows):
    """Each stage's decisions on the small table with all odd cases, one after the other."""
    from tests.llm.test_llm_operators import _components, _contaminated, _removed

    from martforge.llm.common import Scratch

    scratch = Scratch(spark, "stages")
    now = docs.drop("ids")
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.save(stage(spark, now, SF_SMALL), name)
        assert out.columns == now.columns
        steps[name] = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
        now = out
    known = steps["language_id"]
    sets, groups = _components(known)
    assert len(steps["ngram_jaccard_join"]) == len({min(g) for g in groups.values()})
    raws, gone = _removed(steps["ngram_jaccard_join"])
    cut = dict(steps["suffix_array_dedup"])
    for (i, text), g in zip(steps["ngram_jaccard_join"], gone):
        if text is not None and text.isascii() and [x for x, _ in steps["ngram_jaccard_join"]].count(i) == 1:
            assert cut[i] == "".join(c for c, x in zip(text, g) if not x)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = [c[5] for c in _contaminated(steps["suffix_array_dedup"], items)]
    want = sorted((i for (i, _), h in zip(steps["suffix_array_dedup"], hit) if not h), key=str)
    assert sorted((i for i, _ in steps["benchmark_decontamination"]), key=str) == want
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF_SMALL)
    assert last.count() == len(want) and last.filter("NOT lossless").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert 0 < out.count() <= spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert out.filter("NOT lossless").count() == 0


def test_stages_on_an_empty_table(spark):
    now = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_SMALL)
        assert now.count() == 0
