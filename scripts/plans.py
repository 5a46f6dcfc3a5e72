"""Write PLANS.md: physical plans of the headline operators at a scale factor.

Usage: python scripts/plans.py [SF_DIR] > PLANS.md

Streaming flows are shown through their per-micro-batch transform applied to
a bounded frame of the same shape (the plan Spark runs inside each batch).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tierline.functions.triage import DEFAULT_OUTCOME  # noqa: E402
from tierline.operators.enrich import left_enrich  # noqa: E402
from tierline.plans.gold import gold_staged, merge_into_target  # noqa: E402
from tierline.plans.silver import silver_events, silver_tickets  # noqa: E402
from tierline.registry import QUERIES, TEXT_RULES  # noqa: E402
from tierline.session import build_session, scratch_path  # noqa: E402
from tierline.testbed import doc_tickets, labeled_tickets, raw_events, user_dimension  # noqa: E402

NOTES = {
    "gold_product_metrics": "Column-pruned scan, partial aggregate before the only exchange.",
    "gold_staged_row": "All five gold measures in one aggregation; labels broadcast by size.",
    "triage_rules": "One fused projection: lower-cased once, rules as one CASE WHEN, no Python.",
    "batch_left_join": "Dimension pruned in its scan; broadcast (size checked) so the facts are never shuffled.",
    "salted_left_join": ("Above the broadcast bound (automatic broadcasting is off for this plan): a sort-merge "
                         "join on (key, salt). Null keys and the measured hot keys, a broadcast of at most "
                         "1 / share rows, are spread by a hash of the row; the dimension's rows are replicated "
                         "for the hot keys only."),
    "silver_events (per micro-batch)": "Key filter, broadcast left join, stamp and parse in one stage.",
    "silver_tickets (per micro-batch)": "Key filter and triage in one stage.",
    "incremental gold (streaming micro-batch)": (
        "Executed micro-batch plan of the streaming aggregation: partial aggregate, one exchange, "
        "merge with the state store (restore/save), final aggregate. A hot product still ships one "
        "row per map task."),
    "gold upsert (merge)": ("Staged keys within the broadcast bound: the target is split by a broadcast "
                            "anti join (survivors) and a broadcast semi join (rows being replaced); the "
                            "target is never shuffled. Above the bound: one full outer join on the key."),
}


def plans(spark, sf):
    yield "gold_product_metrics", QUERIES["gold_product_metrics"](spark, sf)
    yield "gold_staged_row", QUERIES["gold_staged_row"](spark, sf)
    yield "triage_rules", QUERIES["triage_rules"](spark, sf)
    yield "batch_left_join", left_enrich(raw_events(spark, sf), user_dimension(spark, sf), "user_id",
                                         broadcast_max_rows=5_000_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield "salted_left_join", QUERIES["salted_left_join"](spark, sf)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    yield "silver_events (per micro-batch)", silver_events(
        raw_events(spark, sf), user_dimension(spark, sf), broadcast_max_rows=5_000_000)
    bronze = doc_tickets(spark, sf).withColumn("ingested_at", F.current_timestamp())
    yield "silver_tickets (per micro-batch)", silver_tickets(bronze, TEXT_RULES, DEFAULT_OUTCOME)
    current = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("source").alias("product_id")).distinct()
    staged = gold_staged(labeled_tickets(spark, sf)).filter("product_id is not null")
    yield "gold upsert (merge)", merge_into_target(current, staged)


def streaming_gold_plan(spark, sf) -> str:
    """Run the incremental gold aggregation once over silver-shaped order lines
    and return the plan Spark executed for the micro-batch."""
    root = scratch_path(spark, "plans-incremental")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").cast("string").alias("ticket_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").alias("urgency_score"),
        F.lit(None).cast("string").alias("sentiment"),
    )
    rows.write.parquet(f"{root}/silver")
    metrics = gold_staged(spark.readStream.schema(rows.schema).parquet(f"{root}/silver"))
    query = (metrics.writeStream.outputMode("update").format("noop")
             .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    query.awaitTermination()
    return query._jsq.explainInternal(False).replace("== Physical Plan ==", "").strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Physical plans (before adaptive re-planning) at `{sf}`, generated by `scripts/plans.py`.\n")
    for name, df in plans(spark, sf):
        plan = df._jdf.queryExecution().executedPlan().treeString()
        print(f"## {name}\n\n{NOTES.get(name, '')}\n\n```\n{plan.strip()}\n```\n")
    name = "incremental gold (streaming micro-batch)"
    print(f"## {name}\n\n{NOTES[name]}\n\n```\n{streaming_gold_plan(spark, sf)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
