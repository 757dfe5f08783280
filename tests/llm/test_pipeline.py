"""The pipeline's stages: each one's decisions take effect, columns stay, clean documents are kept."""

import corpus_pipeline
import duckdb
import pytest

import __spark_entry__
from tidemark.llm import decontaminate, linededup
from tidemark.llm.common import table, written


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    names = docs.columns
    before = docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), name)
        if name != "mixing":
            assert out.columns == names and dict(out.dtypes) == dict(docs.dtypes)
        seen[name] = out
        docs = out
    assert seen["language_id"].count() == before
    text = {r["doc_id"]: r for r in seen["line_dedup"].collect()}
    assert all(r["n_chars"] == len(r["text"]) and r["text"] for r in text.values())
    assert decontaminate.leaks(seen["decontamination"], table(spark, sf, "benchmark")).count() == 0
    assert linededup.dedup_lines(seen["line_dedup"]).agg({"n_removed": "sum"}).first()[0] <= 200
    kept = {r["doc_id"] for r in seen["near_dedup"].collect()}
    gone = set(text) - kept
    assert len(gone) < 0.1 * before
    assert {"topic", "weight", "probability"} <= set(seen["mixing"].columns) and seen["mixing"].count() < len(kept)


def test_run_equals_stages(spark, sf):
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), name)
    assert sorted(r["doc_id"] for r in docs.collect()) == sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect())


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a text of some words", None, "s", 20)]])
def test_odd_documents(spark, sf, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "odd")
    assert docs.count() <= 1


def test_columns_of_any_name_pass_all_stages_but_the_last(spark, sf):
    names = ["emptied", "removed", "_key", "kept", "component_id", "item_id", "spans", "topic", "_source"]
    docs = table(spark, sf, "documents").limit(40)
    docs = docs.select("*", *[docs["doc_id"].alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), "clash")
        if name != "mixing":
            assert out.columns == docs.columns and all(r["emptied"] == r["doc_id"] == r["_source"] for r in out.collect())
            docs = out
    assert out.columns.count("topic") == 1 and out.count() > 0


def test_registered():
    q = __spark_entry__.queries()
    assert "pipeline" in q and all(any(n.startswith(f"op{k}_") for n in q) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(q)


def test_url_oracle(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf}/pages.parquet'")
    out = con.execute(__spark_entry__.oracle_sql()["op6_url_filter"])
    names = [d[0] for d in out.description]
    got = __spark_entry__.queries()["op6_url_filter"](spark, sf)
    assert sorted(tuple(r[c] for c in names) for r in map(lambda r: {c: str(r[c]) for c in names}, got.collect())) == sorted(tuple(map(str, r)) for r in out.fetchall())
