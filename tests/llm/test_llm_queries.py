"""Registered queries against their SQL, and the pipeline against plain Python, on the small tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from cardsentry.llm import queries as Q
from cardsentry.llm import decontaminate as D, line_dedup as L
from tests import compare

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert [sum(n.startswith(f"op{k}_") for n in Q.QUERIES) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in Q.QUERIES and set(Q.ORACLE_SQL) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert compare.difference(Q.QUERIES[name](spark, SF), compare.connect(SF), Q.ORACLE_SQL[name]) is None


def test_leaks_are_the_verbatim_ones(spark):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = con.execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    said = [(d, f" {' '.join(D.words(t))} ") for d, t in docs]
    verbatim = {(d, i) for i, t in items for d, text in said if f" {' '.join(D.words(t))} " in text}
    got = {(r["doc_id"], r["item_id"]) for r in Q.QUERIES["op3_decontaminate"](spark, SF).collect()}
    assert verbatim <= got and verbatim


def test_pipeline_stage_by_stage(spark):
    """Each stage's decisions, worked out again from its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [{r["doc_id"]: r["text"] for r in docs.collect()}]
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, SF).cache()
        assert held.columns == docs.columns
        texts.append({r["doc_id"]: r["text"] for r in held.collect()})
    raw, clean, cut, single, free = texts
    toxic = dict(duckdb.connect().execute(
        f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    gone = set(raw) - set(clean)
    assert sum(toxic.get(d) == 0 for d in gone) <= 5 and all(raw[d] == clean[d] for d in clean)

    seen: dict[str, int] = {}
    for doc in sorted(clean):  # exact repeats at least; near ones are tested elsewhere
        lines = (clean[doc] or "").split("\n")
        kept = (cut.get(doc) or "").split("\n")
        part = {x.strip() for _, x in L.lines_of(clean[doc], 5)}
        fresh = [x for x in lines if x.strip() not in part or x.strip() not in seen]
        assert len(kept) <= len(fresh) or not (cut.get(doc) or "").strip()
        seen.update((x, doc) for x in part)
    assert set(single) <= set(cut) and all(single[d] == cut[d] for d in single)
    items = duckdb.connect().execute(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()
    for doc, text in single.items():
        flat = f" {' '.join(D.words(text))} "
        if any(f" {' '.join(D.words(t))} " in flat for (t,) in items):
            assert doc not in free
    packed = corpus_pipeline.STAGES[-1][1](spark, held, SF).collect()
    assert {r["doc_id"] for r in packed} == set(free)
