import pytest
from pyspark.sql import functions as F

from tierline.llm import mixing


def targets(spark, sizes):
    df = spark.createDataFrame(sizes, "source string, source_size long")
    return {r.source: r.target for r in mixing.source_targets(df).collect()}


def reshare(sizes, weights=(5, 2, 1)):
    """The contract's loop: cap, reshare the excess by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_weight = sum(w[s] for s in names if s not in capped)
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: 3 * sizes[s] if s in capped else left * w[s] / open_weight for s in names}
        above = {s for s in names if s not in capped and share[s] > 3 * sizes[s]}
        if not above:
            return share
        capped |= above


@pytest.mark.parametrize("sizes", [
    {"a": 100}, {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5000, None: 10},
    {"a": 0, "b": 10}, {"é": 3, "z": 3, "Z": 3, "": 90}, {"a": 0}, {"a": 2, "b": 3, "c": 10_000, "d": 4, "e": 7},
])
def test_targets_follow_the_resharing_loop(spark, sizes):
    assert targets(spark, list(sizes.items())) == pytest.approx(reshare(sizes))


def test_taken_words_come_near_the_targets(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    quality = mixing.label_weights(spark.read.parquet(f"{sf}/labels.parquet"))
    plan = mixing.mix_plan(docs, quality)
    rows = plan.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_plan(docs, quality).collect()))  # reruns agree
    by_source = {}
    for r in rows:
        assert 0 <= r.copies <= 3
        taken, _, largest = by_source.get(r.source, (0, 0, 0))
        by_source[r.source] = taken + r.size * r.copies, r.target, max(largest, r.size)
        whole = int(r.target // r.source_size)
        assert r.copies in (whole, whole + 1)  # complete epochs come first
    for taken, target, largest in by_source.values():
        assert abs(taken - target) <= largest / 2
    assert sum(abs(taken - target) for taken, target, _ in by_source.values()) < 0.02 * sum(t for _, t, _ in by_source.values())


def test_better_documents_are_taken_more_often(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'one two three' as text", "if(id % 4 = 0, 'b', 'a') as source")
    quality = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, 4, 1) as quality_weight")
    rows = mixing.mix_plan(docs, quality).filter("source = 'b'").groupBy().agg(F.avg("copies")).first()[0]
    assert 0.5 < rows < 3
    taken = mixing.mix_plan(docs.withColumn("source", F.when(F.col("doc_id") < 1000, "x").otherwise("y")), quality)
    share = {r.good: r.share for r in taken.filter("source = 'y'").groupBy((F.col("doc_id") % 2 == 0).alias("good"))
             .agg(F.avg("copies").alias("share")).collect()}
    assert share[True] > share[False]


def test_edges(spark, edge_docs, no_docs):
    plan = mixing.mix_plan(edge_docs)
    rows = plan.collect()
    assert sum(r.rows for r in rows) == 12
    sizes = {(r.doc_id, r.source): (r.size, r.rows) for r in rows if r.doc_id != 5}
    assert sizes[1, "a"] == (14, 2) and sizes[3, "b"] == (0, 1) and sizes[4, "b"] == (0, 1) and sizes[6, None] == (0, 1)
    clash = edge_docs.withColumnsRenamed({"lang": "mix_size", "n_chars": "copies"})
    mixed = mixing.apply_mix(clash, mixing.mix_plan(clash))
    assert mixed.columns == clash.columns
    assert mixed.count() == sum(r.copies * r.rows for r in rows)
    assert mixing.mix_plan(no_docs).count() == 0
    assert mixing.apply_mix(no_docs, mixing.mix_plan(no_docs)).count() == 0
