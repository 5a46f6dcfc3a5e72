import json

import duckdb
import pytest

from helpers import SF_SMOKE, write_text
from tierline.plans.chain import ChainPaths, run_chain
from tierline.registry import ORACLES, QUERIES
from tierline.sinks.target import read_target

import __spark_entry__ as spark_entry
from scripts.parity import TABLES, digest

# Two satisfied, two delayed, two broken: mean urgency 3.
TEXTS = ["fine kettle", "a confusing lamp", "the battery is flat", "delayed twice", "good value", "it broke"]


def test_chain_on_templates(spark, workdir):
    tickets = [{"ticket_id": f"T{i}", "customer_id": "CUST-5001", "product_id": "PROD-1001",
                "review_text": t, "timestamp": "2026-01-02T03:04:05Z"} for i, t in enumerate(TEXTS)]
    tickets.append({"ticket_id": "T-null", "customer_id": "CUST-5002", "product_id": None,
                    "review_text": "fine", "timestamp": "bad"})
    write_text(f"{workdir}/landing", "batch_1.json", json.dumps(tickets, indent=2))
    paths = ChainPaths.under(workdir)
    res = run_chain(spark, paths)
    gold = {r["product_id"]: r for r in read_target(spark, paths.gold).collect()}
    assert set(gold) == {"PROD-1001"}                      # null product went to rejects
    g = gold["PROD-1001"]
    assert (g["total_reviews"], g["avg_urgency"]) == (6, 3.0)
    assert (g["negative_ticket_count"], g["positive_ticket_count"]) == (4, 2)
    assert str(g["avg_urgency_rating"]) == "3.00"
    assert spark.read.parquet(paths.rejects).count() == 1
    # replay: nothing new lands, the published values stay the same
    res2 = run_chain(spark, paths)
    g2 = read_target(spark, paths.gold).collect()[0]
    assert (g2["total_reviews"], g2["avg_urgency"]) == (6, 3.0)


def test_entry_smoke(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0
    assert "product_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_iso_round_trip_in_another_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    query = QUERIES["iso_timestamp_roundtrip"].__wrapped__
    rows = query(spark, SF_SMOKE)
    try:
        zoned = rows.selectExpr("iso_text", "ts")
        assert zoned.filter("iso_text != concat(replace(substring(cast(ts as string), 1, 19), ' ', 'T'), "
                            "'.', rpad(split_part(cast(ts as string), '.', 2), 6, '0'), 'Z')").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity_smoke(spark, duck, name):
    df = QUERIES[name](spark, SF_SMOKE)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_incremental_gold_equals_full(spark, workdir):
    first = [{"ticket_id": f"T{i}", "customer_id": "CUST-5001", "product_id": "PROD-1001" if i % 2 else "PROD-1002",
              "review_text": t, "timestamp": "2026-01-02T03:04:05Z"} for i, t in enumerate(TEXTS)]
    second = [dict(t, ticket_id=t["ticket_id"] + "b", product_id="PROD-1003" if i == 0 else t["product_id"])
              for i, t in enumerate(first)]
    second.append({"ticket_id": "N1", "customer_id": "CUST-5002", "product_id": None,
                   "review_text": "x", "timestamp": "bad"})
    inc, full = ChainPaths.under(f"{workdir}/inc"), ChainPaths.under(f"{workdir}/full")
    write_text(inc.landing, "1.json", json.dumps(first))
    write_text(full.landing, "1.json", json.dumps(first))
    r1 = run_chain(spark, inc, incremental=True)
    assert spark.read.parquet(r1.path).count() == 2
    write_text(inc.landing, "2.json", json.dumps(second))
    write_text(full.landing, "2.json", json.dumps(second))
    r_inc = run_chain(spark, inc, incremental=True)
    r_full = run_chain(spark, full)
    cols = ["product_id", "total_reviews", "avg_urgency", "avg_urgency_rating",
            "negative_ticket_count", "positive_ticket_count"]
    got = sorted(tuple(r) for r in spark.read.parquet(r_inc.path).select(cols).collect())
    want = sorted(tuple(r) for r in spark.read.parquet(r_full.path).select(cols).collect())
    assert got == want and len(got) == 3
    assert spark.read.parquet(inc.rejects).count() == 1   # the null product, from the second load only
    # a rerun without new files publishes nothing new
    again = run_chain(spark, inc, incremental=True)
    assert again.path == r_inc.path


def test_gold_on_missing_silver_is_a_no_op(spark, workdir):
    from tierline.plans.chain import silver_schema
    from tierline.plans.gold import run_gold, run_gold_incremental
    from tierline.functions.triage import DEFAULT_OUTCOME, DEFAULT_RULES
    schema = silver_schema(spark, DEFAULT_RULES, DEFAULT_OUTCOME)
    assert run_gold(spark, f"{workdir}/none", f"{workdir}/gold", schema).path is None
    assert run_gold_incremental(spark, f"{workdir}/none", f"{workdir}/gold", f"{workdir}/ck", schema) is None


def test_unparsable_landing_file_is_rejected_with_its_text(spark, workdir):
    tickets = [{"ticket_id": "T1", "customer_id": "CUST-5001", "product_id": "PROD-1001",
                "review_text": "fine", "timestamp": "2026-01-02T03:04:05Z"},
               {"ticket_id": None, "product_id": "PROD-1001", "review_text": "no id"}]
    write_text(f"{workdir}/landing", "good.json", json.dumps(tickets))
    write_text(f"{workdir}/landing", "broken.json", "[{this is not json")
    paths = ChainPaths.under(workdir)
    res = run_chain(spark, paths)
    assert read_target(spark, paths.gold).collect()[0]["total_reviews"] == 1
    rej = {r["reject_reason"]: r for r in spark.read.parquet(paths.silver_rejects).collect()}
    assert set(rej) == {"unparsable landing file", "missing ticket_id"}
    assert rej["unparsable landing file"]["_corrupt_record"].startswith("[{this is not json")
    assert "_corrupt_record" not in spark.read.parquet(paths.silver).columns
