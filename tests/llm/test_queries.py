"""Registered queries against SQL, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from stockflow.llm import decontaminate, jaccard, quality
from stockflow.llm.common import prepare, table
from stockflow.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.llm.common import SF_DIR, documents, odd_texts, rows_of


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_same_rows_as_sql(name, spark):
    query, sql = QUERIES[name]
    assert differences(query(spark, SF_DIR), connect(SF_DIR), sql) is None


def test_all_are_registered():
    registered = contract.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) <= set(registered) and "pipeline" in registered


def test_pipeline_stages_decide_as_their_operators_do(spark):
    prepare(spark)
    docs = table(spark, SF_DIR, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF_DIR).cache()
    model = quality.train(docs, quality.training_labels(table(spark, SF_DIR, "labels")))
    wanted = {r.doc_id for r in quality.score_texts(docs, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == wanted and 0.7 * docs.count() < len(wanted) < docs.count()
    known = stages["language identification"](spark, good, SF_DIR).cache()
    assert known.count() > 0.95 * good.count()
    single = stages["n-gram Jaccard join"](spark, known, SF_DIR).cache()
    assert {r.doc_id for r in single.collect()} == {r.doc_id for r in jaccard.similar_documents(known).where("doc_id = component_id").collect()}
    clean = stages["benchmark decontamination"](spark, single, SF_DIR).cache()
    hits = decontaminate.find_passages(single, table(spark, SF_DIR, "benchmark")).where(F.size("spans") > 0)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - {r.doc_id for r in hits.collect()}
    for kept in (good, known, single, clean):
        assert kept.schema == docs.schema
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {r.doc_id for r in clean.collect()}


def test_stages_take_odd_rows_and_none(spark):
    odd = documents(spark, rows_of(odd_texts()) + [(None, "no id here", "en", "s", 5), (5, "the id again", "en", "s", 12), (9, odd_texts()[9], "fr", None, 3)])
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF_DIR).count()
        assert stage(spark, odd.limit(0), SF_DIR).count() == 0, name


def test_one_of_each_group_stays_whatever_the_ids(spark):
    prepare(spark)
    texts = odd_texts()
    rows = rows_of(texts) + [(None, "no id here", "en", "s", 5), (None, texts[5], "en", "s", 5), (5, "the id again", "en", "s", 12), (9, texts[9], "fr", None, 3)]
    odd = documents(spark, rows, clashing=True).selectExpr("*", "map('a', doc_id) AS row", "doc_id AS component_id", "text AS first", "1 AS id")
    kept = jaccard.one_of_each(odd.repartition(4))
    assert kept.dtypes == odd.dtypes
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    alone = [(i, t) for i, t in enumerate(texts) if i not in (6, 7, 8)]  # the base in other writing, and with another tail
    assert found == sorted([*alone, (None, "no id here"), (5, "the id again")], key=str)
    single = documents(spark, rows_of(texts), clashing=True).selectExpr("*", "doc_id AS row", "map('a', 1) AS component_id")
    assert sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(single).collect()), key=str) == sorted(alone, key=str)
    assert jaccard.one_of_each(odd.limit(0)).count() == 0
