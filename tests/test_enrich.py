import pytest

from tierline.operators.enrich import left_enrich
from tierline.streaming.runner import run_available_now


@pytest.fixture()
def frames(spark):
    facts = spark.createDataFrame([("e1", "u1"), ("e2", "u9"), ("e3", None), ("e4", "u1")],
                                  "event_id string, user_id string")
    dim = spark.createDataFrame([("u1", "Ann"), ("u2", "Bob")], "user_id string, name string")
    return facts, dim


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_left_outer_semantics(frames):
    facts, dim = frames
    out = left_enrich(facts, dim, "user_id")
    assert out.columns == ["user_id", "event_id", "name"]
    assert _rows(out) == sorted([("u1", "e1", "Ann"), ("u9", "e2", None), (None, "e3", None),
                                 ("u1", "e4", "Ann")], key=str)


def test_strategies_agree(frames):
    facts, dim = frames
    plain = _rows(left_enrich(facts, dim, "user_id"))
    assert _rows(left_enrich(facts, dim, "user_id", salt_buckets=4)) == plain
    assert _rows(left_enrich(facts, dim, "user_id", broadcast_max_rows=10)) == plain
    assert _rows(left_enrich(facts, dim, "user_id", broadcast_max_rows=1)) == plain


def test_broadcast_only_under_bound(frames, spark):
    facts, dim = frames
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = left_enrich(facts, dim, "user_id", broadcast_max_rows=10)
        big = left_enrich(facts, dim, "user_id", broadcast_max_rows=1)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in big._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_dimension_key_refused(frames, spark):
    facts, _ = frames
    dup = spark.createDataFrame([("u1", "Ann"), ("u1", "Other")], "user_id string, name string")
    with pytest.raises(ValueError):
        left_enrich(facts, dup, "user_id", validate_unique=True)


def test_hot_key_salted(spark):
    facts = spark.range(3000).selectExpr("cast(id as string) as event_id",
                                         "case when id % 3 = 0 then 'hot' else cast(id as string) end as user_id")
    dim = spark.createDataFrame([("hot", "H")], "user_id string, name string")
    out = left_enrich(facts, dim, "user_id", salt_buckets=8)
    assert out.count() == 3000
    assert out.filter("name = 'H'").count() == 1000


def test_broadcast_bounded_by_bytes(frames, spark):
    facts, dim = frames
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tiny = left_enrich(facts, dim, "user_id", broadcast_max_rows=10, broadcast_max_bytes=9)
        assert "BroadcastHashJoin" not in tiny._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_hot_keys_are_replicated_and_null_keys_spread(spark):
    from tierline.operators import enrich
    facts = spark.range(3000).selectExpr(
        "cast(id as string) as event_id", "case id % 3 when 0 then 'hot' when 1 then cast(id as string) end as user_id")
    dim = spark.createDataFrame([("hot", "H"), ("1", "A"), ("4", "B")], "user_id string, name string")
    hot = enrich.measured_hot_keys(facts, ["user_id"], 0.01)
    assert [r[0] for r in hot.collect()] == ["hot"]
    for kind in ({"salt_buckets": 8}, {"salt_buckets": 8, "hot_keys": hot}, {}):
        out = left_enrich(facts, dim, "user_id", **kind)
        assert out.columns == ["user_id", "event_id", "name"] and out.count() == 3000
        assert {r["name"]: r["count"] for r in out.groupBy("name").count().collect()} == {"H": 1000, "A": 1, "B": 1, None: 1998}
    plan = left_enrich(facts, dim, "user_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan  # the spread of null keys


def test_streamed_hot_and_null_keys(spark, workdir):
    facts = spark.range(3000).selectExpr(
        "cast(id as string) as event_id", "case id % 3 when 0 then 'hot' when 1 then cast(id as string) end as user_id")
    facts.write.parquet(f"{workdir}/facts")
    dim = spark.createDataFrame([("hot", "H"), ("1", "A")], "user_id string, name string")
    hot = spark.createDataFrame([("hot",)], "user_id string")
    for i, kind in enumerate(({}, {"salt_buckets": 4}, {"salt_buckets": 4, "hot_keys": hot}, {"broadcast_max_rows": 10})):
        stream = spark.readStream.schema(facts.schema).parquet(f"{workdir}/facts")
        run_available_now(left_enrich(stream, dim, "user_id", **kind), f"{workdir}/out{i}", f"{workdir}/ck{i}")
        out = spark.read.parquet(f"{workdir}/out{i}")
        assert out.count() == 3000 and out.filter("name = 'H'").count() == 1000 and out.filter("name = 'A'").count() == 1


def test_key_types_may_differ(spark):
    facts = spark.createDataFrame([("e1", "7"), ("e2", "guest-1"), ("e3", None)], "event_id string, user_id string")
    dim = spark.createDataFrame([(7, "Ann"), (8, "Bob")], "user_id long, name string")
    for kind in ({}, {"broadcast_max_rows": 10}, {"salt_buckets": 4}, {"validate_unique": True}):
        assert _rows(left_enrich(facts, dim, "user_id", **kind)) == sorted(
            [("7", "e1", "Ann"), ("guest-1", "e2", None), (None, "e3", None)], key=str)
    numbers = facts.selectExpr("event_id", "try_cast(user_id as long) as user_id")
    text_dim = spark.createDataFrame([("7", "Ann"), ("x", "Eve")], "user_id string, name string")
    assert ("Ann" in [r["name"] for r in left_enrich(numbers, text_dim, "user_id").collect()])


def test_fits_broadcast(spark):
    from tierline.operators.enrich import fits_broadcast
    dim = spark.range(100).selectExpr("cast(id as string) as user_id", "repeat('x', 10) as name")
    assert fits_broadcast(dim, 100, 10_000)
    assert not fits_broadcast(dim, 99, 10_000)
    assert not fits_broadcast(dim, 100, 100)
