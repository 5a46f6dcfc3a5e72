from pyspark.sql import functions as F

from tierline.llm import sharding
from tierline.llm.queries import op9_extendible_shards
from tierline.session import scratch_path


def shards(docs, limit):
    directory = sharding.build_directory(docs, limit)
    out = sharding.assign_shards(docs, directory)
    return out, out.columns[-1]


def test_splits_only_oversized_buckets(spark, documents):
    limit = 20_000
    out, shard = shards(documents, limit)
    rows = [(r.doc_id, r[shard], len(r.text.encode())) for r in out.collect()]
    assert len(rows) == documents.count()
    total = {}
    for _, s, n in rows:
        total[s] = total.get(s, 0) + n
    assert all(n <= limit or sum(s == t for _, t, _ in rows) == 1 for s, n in total.items())
    for s in total:  # prefix-free, and every parent was too large
        assert not any(t != s and t.startswith(s) for t in total)
        if s != "s":
            assert sum(n for t, n in total.items() if t.startswith(s[:-1])) > limit


def test_deep_directories_go_on_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROUND_BITS", 2)
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('x', 100) as text")
    out, shard = shards(docs, 1000)
    sizes = out.groupBy(shard).count().collect()
    assert sum(r["count"] for r in sizes) == 500 and all(r["count"] <= 10 for r in sizes)
    assert max(len(r[shard]) for r in sizes) > 5


def test_files_hold_every_row(spark, documents):
    path = scratch_path(spark, "test-shards")
    sharding.write_shards(documents, path, 50_000)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(documents).count() == 0 and back.count() == documents.count()
    assert back.select("shard").distinct().count() > 3


def test_one_id_is_written_by_several_tasks(spark):
    docs = spark.range(0, 4000, numPartitions=8).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "repeat('x', 100) as text")
    path = scratch_path(spark, "test-shards")
    sharding.write_shards(docs, path, 20_000)
    back = spark.read.parquet(path)
    per_file = back.filter("doc_id = 7").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 1335 and len(per_file) > 4
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) < 600


def test_query_with_a_column_of_the_same_name(spark, edge_docs, tmp_path):
    edge_docs.withColumn("shard", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op9_extendible_shards(spark, str(tmp_path)).collect()
    assert len(rows) == 12 and {r.shard for r in rows} == {"s"} and {r.shard_docs for r in rows} == {12}


def test_edges(spark, edge_docs, no_docs):
    clash = edge_docs.withColumnsRenamed({"lang": "shard", "source": "shard_bits"})
    out, shard = shards(clash, 1000)
    assert shard == "shard_" and out.columns[:-1] == clash.columns and out.count() == 12
    assert out.filter(F.col(shard).isNull()).count() == 0
    assert {r[shard] for r in out.filter("doc_id = 1").collect()}.__len__() == 1
    out, shard = shards(no_docs, 1000)
    assert out.count() == 0
    path = scratch_path(spark, "test-shards")
    sharding.write_shards(clash, path, 100)  # repeated ids and long texts stay over the limit
    assert spark.read.schema(clash.schema.add("shard_", "string")).parquet(path).count() == 12
