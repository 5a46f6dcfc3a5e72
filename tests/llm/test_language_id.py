import pytest
from pyspark.sql import functions as F

from tierline.llm import language_id as lid
from tierline.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op3_language_id"](spark, sf).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_source_and_ids_are_no_inputs(spark, documents):
    model = lid.train(documents)
    a = lid.predict(documents, model, ["doc_id"]).orderBy("doc_id").collect()
    b = lid.predict(documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model, ["doc_id"])
    assert a == b.orderBy("doc_id").collect()


@pytest.mark.parametrize("labels", [0, 1, 2])
def test_few_labels(spark, documents, labels):
    some = {0: [], 1: ["en"], 2: ["en", "fr"]}[labels]
    model = lid.train(documents.filter(F.col("lang").isin(some) if some else F.lit(False)))
    rows = lid.predict(documents, model, ["doc_id"]).collect()
    assert {r.lid_lang for r in rows} <= set(some or ["und"])


def test_edges(spark, documents, edge_docs, no_docs):
    model = lid.train(documents.unionByName(edge_docs))
    rows = lid.predict(edge_docs, model, ["doc_id", "text"]).collect()
    assert len(rows) == 12
    for r in rows:
        if not lid.has_letter(r.text):
            assert (r.lid_lang, r.lid_score) == ("und", 0.0)
        else:
            assert r.lid_lang in ("en", "de", "fr", "es") and 0 < r.lid_score <= 1
    assert lid.predict(no_docs, lid.train(no_docs), ["doc_id"]).count() == 0


def test_families_cover_related_languages():
    assert lid.family_of("en-US") == lid.family_of("de") != lid.family_of("fr")
    assert lid.family_of("tlh") == "tlh"
