"""Physical-plan properties that matter at scale."""

from tierline.operators.enrich import left_enrich
from tierline.operators.gold import product_metrics
from tierline.operators.keys import require_key
from tierline.plans.silver import silver_events
from tierline.testbed import raw_events, user_dimension

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filter_reaches_parquet_scan(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    plan = _plan(require_key(e, "event_id").select("event_id", "user_id"))
    assert "PushedFilters: [IsNotNull(event_id)]" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_dimension_is_pruned_and_broadcast(spark):
    dim = user_dimension(spark, SF)
    plan = _plan(left_enrich(raw_events(spark, SF), dim, "user_id", broadcast_max_rows=1_000_000))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>" in plan


def test_silver_event_plan_has_one_exchange_at_most(spark):
    plan = _plan(silver_events(raw_events(spark, SF), user_dimension(spark, SF), broadcast_max_rows=1_000_000))
    # broadcast side only: the fact side is never shuffled
    assert plan.count("Exchange hashpartitioning") == 0


def test_gold_shuffles_once_after_partial_aggregation(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "l_partkey as product_id", "l_orderkey as ticket_id", "l_quantity as urgency_score", "'x' as sentiment")
    plan = _plan(product_metrics(li, sentiment="sentiment", rating=True))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")  # partial below the exchange


def test_stream_static_join_broadcasts_in_each_micro_batch(spark, workdir):
    import json as _json
    import os

    from tierline.schemas import RAW_EVENT
    from tierline.sources.files import event_json_stream
    from tierline.streaming.runner import run_available_now

    os.makedirs(f"{workdir}/ev")
    with open(f"{workdir}/ev/a.json", "w") as fh:
        fh.write(_json.dumps([{"event_id": "1", "user_id": "7", "event_type": "click",
                               "timestamp": "2026-01-02T03:04:05Z", "payload": "{}"}]))
    stream = event_json_stream(spark, f"{workdir}/ev", RAW_EVENT)
    joined = silver_events(stream, user_dimension(spark, SF), broadcast_max_rows=1_000_000)
    query = run_available_now(joined, f"{workdir}/out", f"{workdir}/ck")
    plan = query._jsq.explainInternal(False)
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "Exchange hashpartitioning" not in plan
    assert spark.read.parquet(f"{workdir}/out").count() == 1
