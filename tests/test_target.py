import glob
import os

import pytest
from pyspark.sql import functions as F

from tierline.plans.gold import merge_into_target, run_gold, run_gold_incremental
from tierline.schemas import GOLD_TARGET
from tierline.sinks import target as tg
from tierline.sinks.snapshots import upsert
from tierline.streaming.runner import batch_count, processing_time

SCHEMA = "product_id string, total_reviews long"


def rows(spark, values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def merge(target, staged):
    return upsert(target, staged, "product_id", stamp=None)


def put(spark, root, values):
    staged = rows(spark, values)
    tg.merge_target(staged, root, "product_id", merge, staged.schema)


def held(spark, root):
    return {r["product_id"]: r["total_reviews"] for r in tg.read_target(spark, root).collect()}


def files(root):
    return set(glob.glob(f"{root}/*/*/*.parquet"))


def test_merges_replace_keep_and_insert(spark, workdir):
    root = f"{workdir}/gold"
    assert not tg.target_exists(spark, root)
    assert tg.read_target(spark, root, GOLD_TARGET).count() == 0
    with pytest.raises(FileNotFoundError):
        tg.read_target(spark, root)
    put(spark, root, {"A": 1, "B": 2})
    put(spark, root, {"B": 5, "C": 3})
    assert held(spark, root) == {"A": 1, "B": 5, "C": 3}
    put(spark, root, {})  # nothing staged: nothing written
    assert held(spark, root) == {"A": 1, "B": 5, "C": 3}
    assert tg.read_target(spark, root).columns == ["product_id", "total_reviews"]


def test_only_touched_buckets_are_rewritten(spark, workdir, monkeypatch):
    monkeypatch.setattr(tg, "ROWS_PER_BUCKET", 20)
    root = f"{workdir}/gold"
    expected = {f"P{i}": i for i in range(200)}
    put(spark, root, expected)
    assert len(files(root)) == 16
    for n in range(4):
        before = files(root)
        put(spark, root, {f"P{n}": -n, f"new{n}": n})
        expected |= {f"P{n}": -n, f"new{n}": n}
        assert len(files(root) - before) in (1, 2) and len(files(root)) == 16
        assert held(spark, root) == expected


def test_buckets_grow_with_the_target(spark, workdir, monkeypatch):
    monkeypatch.setattr(tg, "ROWS_PER_BUCKET", 10)
    root, expected, layouts = f"{workdir}/gold", {}, []
    for n in range(1, 6):
        part = {f"P{i}": n for i in range(n * n * 4)}
        expected |= part
        put(spark, root, part)
        assert held(spark, root) == expected
        layouts.append([d for d in os.listdir(root) if d.startswith(tg.BUCKETS)])
    assert all(len(one) == 1 for one in layouts)
    assert layouts[0] == ["_buckets=1"] and layouts[-1] in (["_buckets=8"], ["_buckets=16"])
    assert all(len(os.listdir(d)) >= 1 for d in glob.glob(f"{root}/*/*"))


def test_more_touched_buckets_than_can_be_named(spark, workdir, monkeypatch):
    monkeypatch.setattr(tg, "ROWS_PER_BUCKET", 5)
    monkeypatch.setattr(tg, "MAX_NAMED", 3)
    root = f"{workdir}/gold"
    put(spark, root, {f"P{i}": 0 for i in range(60)})
    put(spark, root, {f"P{i}": 1 for i in range(50)})
    assert held(spark, root) == {f"P{i}": int(i < 50) for i in range(60)}


def test_a_run_that_died_is_completed_by_the_next(spark, workdir, monkeypatch):
    monkeypatch.setattr(tg, "ROWS_PER_BUCKET", 5)
    root = f"{workdir}/gold"
    put(spark, root, {f"P{i}": 0 for i in range(30)})
    complete = tg.complete_pending
    for dies_before in (True, False):  # before the target is touched, or before the pending rows are removed
        def dying(session, where, calls=[]):
            if tg._open(session, f"{where}-pending") is None or tg._open(session, f"{where}-pending").isEmpty():
                return complete(session, where)
            if not dies_before:
                monkeypatch.setattr(type(session), "createDataFrame", lambda *a, **k: 1 / 0)
                complete(session, where)
            raise ZeroDivisionError

        staged = rows(spark, {"P1": 7, "new": 1})
        schema = staged.schema
        with monkeypatch.context() as m:
            m.setattr(tg, "complete_pending", dying)
            with pytest.raises(ZeroDivisionError):
                tg.merge_target(staged, root, "product_id", merge, schema)
        monkeypatch.undo()
        monkeypatch.setattr(tg, "ROWS_PER_BUCKET", 5)
        assert (held(spark, root)["P1"] == 7) is not dies_before
        put(spark, root, {"P2": 9})
        assert held(spark, root) == {f"P{i}": {1: 7, 2: 9}.get(i, 0) for i in range(30)} | {"new": 1}
        put(spark, root, {"P1": 0, "P2": 0})


def test_bad_keys_are_refused_and_nothing_is_written(spark, workdir):
    root = f"{workdir}/gold"
    put(spark, root, {"A": 1})
    for keys in ([None], ["A", "A"]):
        staged = spark.createDataFrame([(k, 1) for k in keys], SCHEMA)
        with pytest.raises(ValueError):
            tg.merge_target(staged, root, "product_id", merge, staged.schema)
        with pytest.raises(ValueError):
            tg.replace_target(staged, root, "product_id")
    assert held(spark, root) == {"A": 1}


def test_new_columns_rewrite_the_whole_target(spark, workdir, monkeypatch):
    monkeypatch.setattr(tg, "ROWS_PER_BUCKET", 5)
    root = f"{workdir}/gold"
    narrow = spark.range(40).selectExpr("cast(id as string) as product_id", "id as total_reviews")
    tg.replace_target(narrow, root, "product_id")
    staged = spark.createDataFrame([("3", 30, 1.5)], "product_id string, total_reviews long, avg_urgency double")
    tg.merge_target(staged, root, "product_id", merge_into_target, GOLD_TARGET)
    out = tg.read_target(spark, root)
    assert set(out.columns) == set(GOLD_TARGET.fieldNames()) and out.count() == 40
    assert out.filter("negative_ticket_count = 0").count() == 40
    assert out.filter("last_updated_at is not null").count() == 1  # stamped when merged


def test_target_as_sql_view(spark, workdir):
    staged = spark.createDataFrame([("A", 3, 2.0), ("B", 1, 5.0)],
                                   "product_id string, total_reviews long, avg_urgency double")
    tg.merge_target(staged, f"{workdir}/gold", "product_id", merge_into_target, GOLD_TARGET)
    tg.register_target_view(spark, f"{workdir}/gold", "gold_current")
    got = spark.sql("select product_id from gold_current where avg_urgency > 3 order by product_id").collect()
    assert [r[0] for r in got] == ["B"]


def test_a_drain_merges_once_and_removes_its_deltas(spark, workdir, monkeypatch):
    from tierline.plans import gold
    merges = []
    real = gold.merge_target
    monkeypatch.setattr(gold, "merge_target", lambda *a: merges.append(1) or real(*a))
    silver = spark.range(60).selectExpr("cast(id as string) as ticket_id", "concat('P', id % 3) as product_id",
                                        "cast(1 as double) as urgency_score", "'Positive' as sentiment")
    silver.repartition(6).write.parquet(f"{workdir}/silver")
    args = (spark, f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/ck", silver.schema)
    streams = run_gold_incremental(*args, max_files_per_trigger=1)
    assert batch_count(streams) >= 6 and len(merges) == 1
    assert held(spark, f"{workdir}/gold") == {"P0": 20, "P1": 20, "P2": 20}
    assert glob.glob(f"{workdir}/ck-deltas/*=*") == []
    run_gold_incremental(*args)  # nothing new: no merge
    assert len(merges) == 1
    silver.filter("product_id = 'P0'").write.mode("append").parquet(f"{workdir}/silver")
    run_gold_incremental(*args)
    assert held(spark, f"{workdir}/gold") == {"P0": 40, "P1": 20, "P2": 20}
    assert glob.glob(f"{workdir}/ck-deltas/*=*") == []


def test_deltas_of_a_failed_drain_are_merged_by_the_next(spark, workdir, monkeypatch):
    from tierline.plans import gold
    silver = spark.range(60).selectExpr("cast(id as string) as ticket_id", "concat('P', id % 3) as product_id",
                                        "cast(1 as double) as urgency_score", "'Positive' as sentiment")
    silver.repartition(3).write.parquet(f"{workdir}/silver")
    args = (spark, f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/ck", silver.schema)
    with monkeypatch.context() as m:
        m.setattr(gold, "merge_target", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_gold_incremental(*args)
    assert not tg.target_exists(spark, f"{workdir}/gold") and glob.glob(f"{workdir}/ck-deltas/*=*")
    run_gold_incremental(*args)
    assert held(spark, f"{workdir}/gold") == {"P0": 20, "P1": 20, "P2": 20}
    assert glob.glob(f"{workdir}/ck-deltas/*=*") == []


def test_a_running_stream_merges_every_batch(spark, workdir):
    silver = spark.range(6).selectExpr("cast(id as string) as ticket_id", "concat('P', id % 3) as product_id",
                                       "cast(1 as double) as urgency_score", "'Positive' as sentiment")
    silver.write.parquet(f"{workdir}/silver")
    streams = run_gold_incremental(spark, f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/ck", silver.schema,
                                   trigger=processing_time("0 seconds"))
    try:
        streams.processAllAvailable()
        assert held(spark, f"{workdir}/gold") == {"P0": 2, "P1": 2, "P2": 2}
        silver.filter("product_id = 'P1'").write.mode("append").parquet(f"{workdir}/silver")
        streams.processAllAvailable()
    finally:
        streams.stop()
    assert held(spark, f"{workdir}/gold") == {"P0": 2, "P1": 4, "P2": 2}
    assert not os.path.exists(f"{workdir}/ck-deltas")


def test_gold_rejects_are_tickets_written_once(spark, workdir):
    schema = "ticket_id string, product_id string, urgency_score double, sentiment string"
    loads = [[("a", None, 1.0, None), ("b", "P", 2.0, None)], [("c", None, 1.0, None), ("d", None, 1.0, None)]]
    full = spark.createDataFrame([], schema).schema
    for load in loads:
        spark.createDataFrame(load, schema).write.mode("append").parquet(f"{workdir}/silver")
        run_gold_incremental(spark, f"{workdir}/silver", f"{workdir}/gold", f"{workdir}/ck", full, f"{workdir}/rejects")
        result = run_gold(spark, f"{workdir}/silver", f"{workdir}/gold-full", full, f"{workdir}/rejects-full")
    for path in ("rejects", "rejects-full"):
        rows = spark.read.parquet(f"{workdir}/{path}").collect()
        assert sorted(r["ticket_id"] for r in rows) == ["a", "c", "d"]
        assert {r["reject_reason"] for r in rows} == {"missing product_id"}
    assert result.path and tg.read_target(spark, f"{workdir}/gold-full").count() == 1
