"""The registered queries and the pipeline on the small tables."""

import duckdb
import pytest

import corpus_pipeline
from geomere.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, data, name):
    found = queries.QUERIES[name](spark, data)
    assert found.count() > 0
    if name in queries.ORACLES:
        db = duckdb.connect()
        for t in ("documents", "conversations"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
        got = db.execute(queries.ORACLES[name])
        names = [d[0] for d in got.description]
        assert sorted(map(str, (tuple(r[n] for n in names) for r in found.collect()))) == sorted(map(str, got.fetchall()))


def test_pipeline_keeps_columns_and_clean_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs, out))
        assert after <= before
        if name == "language":
            assert len(after) >= 0.98 * len(before)
        if name == "toxicity":
            assert len(before - after - toxic) <= 0.02 * len(before)
        if name == "pii":
            assert before == after
        docs = out


def test_stages_take_odd_and_empty_tables(spark, data, docs, empty):
    odd = docs.withColumn("n_chars", docs.n_chars.cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, data)
        nothing = stage(spark, empty, data)
        assert nothing.count() == 0
        if name != "packing":
            assert out.columns == nothing.columns == odd.columns, name
            given, kept = ({(r.doc_id, r.text or "") for r in x.collect()} for x in (odd, out))
            assert len(kept) <= len(given) and (name == "pii" or kept <= given)
            assert (name != "toxicity" and name != "pii") or len(kept) == len(given)
            assert name != "language" or all(any(c.isalpha() for c in t) for _, t in kept)
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in odd.collect()}


def test_run_forgets_what_it_made_on_its_way(spark, data):
    from geomere.session import tables

    before = list(tables(spark))
    out = corpus_pipeline.run(spark, data)
    assert len(tables(spark)) == len(before) + 1 and out.count() > 0
