import json

from helpers import write_text
from tierline.cli import dispatch, parser
from tierline.sinks.target import read_target

# Two satisfied, two delayed, two broken: mean urgency 3.
TEXTS = ["fine kettle", "a confusing lamp", "the battery is flat", "delayed twice", "good value", "it broke"]


def test_chain_and_gold_jobs(spark, workdir, capsys):
    tickets = [{"ticket_id": f"T{i}", "customer_id": "CUST-5001", "product_id": "PROD-1001",
                "review_text": t, "timestamp": "2026-01-02T03:04:05Z"} for i, t in enumerate(TEXTS)]
    write_text(f"{workdir}/landing", "batch_1.json", json.dumps(tickets, indent=2))
    assert dispatch(spark, parser().parse_args(["chain", "--root", workdir])) == 0
    published = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["published"]
    assert published == f"{workdir}/gold"
    row = read_target(spark, f"{workdir}/gold").collect()[0]
    assert (row["total_reviews"], row["avg_urgency"]) == (6, 3.0)
    # the gold job alone, incremental, on the silver the chain wrote
    args = parser().parse_args(["gold", "--silver", f"{workdir}/silver", "--target", f"{workdir}/gold2",
                                "--incremental-checkpoint", f"{workdir}/ck-gold2"])
    assert dispatch(spark, args) == 0
    assert read_target(spark, f"{workdir}/gold2").collect()[0]["total_reviews"] == 6


def test_silver_events_job(spark, workdir):
    events = [{"event_id": "1", "user_id": "7", "event_type": "click", "timestamp": "2026-01-02T03:04:05Z",
               "payload": "{}"}, {"event_id": None, "user_id": "8", "event_type": "view",
                                  "timestamp": "bad", "payload": "{}"}]
    write_text(f"{workdir}/ev", "a.json", json.dumps(events))
    write_text(f"{workdir}/ev", "b.json", "{broken event line")
    spark.createDataFrame([("7", "Ann")], "user_id string, name string").write.parquet(f"{workdir}/dim")
    args = parser().parse_args(["silver-events", "--source", f"{workdir}/ev", "--out", f"{workdir}/silver",
                                "--checkpoint", f"{workdir}/ck", "--dimension-parquet", f"{workdir}/dim",
                                "--rejects", f"{workdir}/rejects", "--snapshot-dimension"])
    assert dispatch(spark, args) == 0
    silver = spark.read.parquet(f"{workdir}/silver").collect()
    assert [(r["event_id"], r["name"]) for r in silver] == [("1", "Ann")]
    reasons = sorted(r["reject_reason"] for r in spark.read.parquet(f"{workdir}/rejects").collect())
    assert reasons == ["missing event_id", "unparsable event line"]
    assert "_corrupt_record" not in spark.read.parquet(f"{workdir}/silver").columns
