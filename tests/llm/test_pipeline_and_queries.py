"""The registered queries on the small table, and the pipeline against its stages."""

import duckdb
import pytest
from conftest import DATA

import corpus_pipeline
from dwellgrid.llm import neardup, pii, quality, toxicity
from dwellgrid.llm import queries as llm
from dwellgrid.llm.queries import table


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = llm.queries()[name](spark, DATA)
    found = con.execute(llm.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted((tuple(r) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == theirs


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql())))
def test_query_covers_its_table(spark, name):
    rows = llm.queries()[name](spark, DATA)
    source = {"op3": "embeddings", "op8": "pages"}.get(name.split("_")[0], "documents")
    total = table(spark, DATA, source).count()
    if name.startswith("op3"):
        assert rows.count() == 20 * table(spark, DATA, source).filter("vec_id % 20 = 0").count()
    elif name.startswith("op10"):
        assert rows.select("doc_id").distinct().count() == total
    else:
        assert rows.count() == total


def test_pipeline_equals_its_decisions(spark):
    docs = table(spark, DATA, "documents")
    labels = table(spark, DATA, "labels")
    good = quality.rules(docs).filter("kept").select("doc_id")
    left = docs.join(good, "doc_id", "left_semi")
    model = toxicity.fit(left, labels)
    mild = toxicity.rated(left, model).filter("predicted = 0").select("doc_id")
    left = left.join(mild, "doc_id", "left_semi")
    own = neardup.near_duplicates(left).filter("kept").select("doc_id")
    want = {r["doc_id"] for r in own.collect()}
    out = corpus_pipeline.run(spark, DATA)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == want
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = table(spark, DATA, "documents").limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0


def test_redaction_takes_effect(spark):
    docs = table(spark, DATA, "documents")
    safe = pii.redacted(docs)
    again = pii.found(safe, pii.Field()).selectExpr("explode(filter(spans, x -> x.base)) AS s")
    assert again.count() == 0
    assert safe.filter("n_chars != length(text)").count() == 0
