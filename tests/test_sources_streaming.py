import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from helpers import write_text
from tierline.plans.bronze import run_bronze
from tierline.plans.chain import ChainPaths, run_chain
from tierline.plans.silver import run_silver_events
from tierline.schemas import RAW_EVENT, TICKET
from tierline.sinks.landing import landing_arrays, write_landing_files
from tierline.sources.files import (
    event_json_stream, landing_json_stream, read_json_batch, read_parquet_guarded,
)
from tierline.streaming.runner import batches_with_input, processing_time, run_available_now

TICKETS = [
    {"ticket_id": f"T{i}", "customer_id": "CUST-5000", "product_id": "PROD-1001",
     "review_text": "battery dies" if i % 2 else "great", "timestamp": "2026-01-02T03:04:05Z"}
    for i in range(7)
]


def test_no_landed_ticket_disappears(spark, workdir):
    """Two arrays in a file, a broken file and a broken tail: rows in = rows
    out + rejects, and rejects keep the whole text."""
    paths = ChainPaths.under(workdir)
    write_text(paths.landing, "a.json", json.dumps(TICKETS[:2], indent=2))
    write_text(paths.landing, "b.json", "this is not json")
    two = json.dumps(TICKETS[2:4]) + "\n" + json.dumps(TICKETS[4:6])
    write_text(paths.landing, "c.json", two)
    write_text(paths.landing, "d.json", json.dumps(TICKETS[6]))
    write_text(paths.landing, "e.json", " \n")
    run_chain(spark, paths)
    silver = spark.read.parquet(paths.silver)
    assert sorted(r["ticket_id"] for r in silver.collect()) == ["T0", "T1", "T6"]
    rejects = {r["_corrupt_record"]: r["reject_reason"] for r in spark.read.parquet(paths.silver_rejects).collect()}
    assert rejects == {"this is not json": "unparsable landing file", two: "unparsable landing file"}


def test_no_event_line_disappears(spark, workdir):
    event = {"event_id": "1", "user_id": "7", "event_type": "click", "timestamp": "x", "payload": "{}"}
    lines = [json.dumps(event), json.dumps(event) + json.dumps(event), json.dumps([event, event]), "", "{broken"]
    write_text(f"{workdir}/ev", "a.json", "\n".join(lines))
    dim = spark.createDataFrame([("7", "Ann")], "user_id string, name string")
    run_silver_events(spark, f"{workdir}/ev", dim, f"{workdir}/silver", f"{workdir}/ck", rejects=f"{workdir}/rejects")
    assert spark.read.parquet(f"{workdir}/silver").count() == 3
    rejects = spark.read.parquet(f"{workdir}/rejects").collect()
    assert sorted(r["_corrupt_record"] for r in rejects) == sorted([lines[1], lines[4]])
    assert {r["reject_reason"] for r in rejects} == {"unparsable event line"}


def test_both_event_streams_are_stopped(spark, workdir):
    event = {"event_id": None, "user_id": "7", "event_type": "click", "timestamp": "x", "payload": "{}"}
    write_text(f"{workdir}/ev", "a.json", json.dumps(event))
    dim = spark.createDataFrame([("7", "Ann")], "user_id string, name string")
    before = len(spark.streams.active)
    streams = run_silver_events(spark, f"{workdir}/ev", dim, f"{workdir}/silver", f"{workdir}/ck",
                                rejects=f"{workdir}/rejects", trigger=processing_time("1 second"))
    assert len(spark.streams.active) == before + 3
    for _ in range(2):  # landed first, then read
        streams.processAllAvailable()
    streams.stop()
    assert len(spark.streams.active) == before and streams.exception() is None
    assert spark.read.parquet(f"{workdir}/rejects").count() == 1


def test_pretty_array_needs_multiline(spark, workdir):
    land = f"{workdir}/events"
    ev = [{"event_id": "1", "user_id": "u", "event_type": "click", "timestamp": "x", "payload": "{}"}]
    write_text(land, "pretty.json", json.dumps(ev, indent=2))
    write_text(land, "line.json", json.dumps(ev))
    rows = read_json_batch(spark, land, RAW_EVENT, multi_line=False)
    assert rows.filter("event_id is not null").count() == 1  # only the one-line array


def test_schema_on_read(spark, workdir):
    land = f"{workdir}/p6"
    write_text(land, "x.json", json.dumps([{"ticket_id": "T1", "extra": 5, "meta": {"a": 1, "b": "x"}}]))
    r = read_json_batch(spark, land, StructType(TICKET.fields + [StructField("meta", StringType())]), multi_line=True).collect()[0]
    assert r["customer_id"] is None and json.loads(r["meta"]) == {"a": 1, "b": "x"}
    assert "extra" not in r.asDict()


def test_guarded_parquet(spark, workdir):
    schema = "a int"
    assert read_parquet_guarded(spark, f"{workdir}/missing", spark.createDataFrame([], schema).schema).count() == 0
    spark.range(5).selectExpr("cast(id as int) as a").write.parquet(f"{workdir}/real")
    df = read_parquet_guarded(spark, [f"{workdir}/real", f"{workdir}/missing"],
                              spark.createDataFrame([], schema).schema)
    assert df.count() == 5


def test_landing_writer_one_array_per_file(spark, workdir):
    src = spark.range(0, 1000, numPartitions=3).selectExpr(
        "cast(id as string) as ticket_id", "cast(null as string) as customer_id",
        "'P' as product_id", "repeat('word ', cast(id % 50 as int)) as review_text",
        "'2026-01-02T03:04:05Z' as timestamp")
    arrays = landing_arrays(src, 7).collect()
    assert all(1 <= len(json.loads(a[0])) <= 7 for a in arrays)
    land = f"{workdir}/landing"
    write_landing_files(src, land, 7)
    files = [f for f in os.listdir(land) if f.endswith(".txt")]
    assert len(files) == len(arrays)
    back = read_json_batch(spark, land, TICKET, multi_line=True)
    assert back.count() == 1000
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_bronze_rerun_adds_nothing_and_restart_equals_one_run(spark, workdir):
    land, bronze, ckpt = f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ckpt"
    write_text(land, "1.json", json.dumps(TICKETS[:4]))
    run_bronze(spark, land, bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 4
    again = run_bronze(spark, land, bronze, ckpt)
    assert batches_with_input(again) == 0 and spark.read.parquet(bronze).count() == 4
    write_text(land, "2.json", json.dumps(TICKETS[4:]))
    run_bronze(spark, land, bronze, ckpt)
    got = spark.read.parquet(bronze)
    assert got.count() == 7 and got.filter("ingested_at is null").count() == 0
    one = f"{workdir}/one"
    run_bronze(spark, land, one, f"{workdir}/ckpt-one")
    cols = [c for c in TICKET.fieldNames()]
    assert got.select(cols).exceptAll(spark.read.parquet(one).select(cols)).count() == 0


def test_rate_limit_batches(spark, workdir):
    land = f"{workdir}/ev"
    for i in range(6):
        ev = [{"event_id": str(i), "user_id": "u", "event_type": "click",
               "timestamp": "2026-01-02T03:04:05Z", "payload": "{}"}]
        write_text(land, f"{i}.json", json.dumps(ev))
    q = run_available_now(event_json_stream(spark, land, max_files_per_trigger=2),
                          f"{workdir}/out", f"{workdir}/ck")
    assert batches_with_input(q) == 3
    assert spark.read.parquet(f"{workdir}/out").count() == 6


def test_landing_stream(spark, workdir):
    land = f"{workdir}/landing"
    write_text(land, "a.json", json.dumps(TICKETS, indent=2))
    run_available_now(landing_json_stream(spark, land), f"{workdir}/o", f"{workdir}/c")
    assert spark.read.parquet(f"{workdir}/o").select(F.countDistinct("ticket_id")).collect()[0][0] == 7


def test_landing_writer_byte_bound(spark):
    src = spark.range(0, 50, numPartitions=1).selectExpr("cast(id as string) as ticket_id",
                                                         "repeat('x', 1000) as review_text")
    arrays = [json.loads(a[0]) for a in landing_arrays(src, 100, max_bytes_per_file=5000).collect()]
    assert sum(len(a) for a in arrays) == 50
    assert all(len(a) <= 4 for a in arrays) and len(arrays) >= 12


def test_corrupt_record_column_keeps_the_text(spark, workdir):
    land = f"{workdir}/landing"
    write_text(land, "good.json", json.dumps(TICKETS[:2]))
    write_text(land, "bad.json", "{not json")
    schema = StructType(TICKET.fields + [StructField("_corrupt", StringType())])
    rows = read_json_batch(spark, land, schema, multi_line=True, corrupt_column="_corrupt")
    bad = rows.filter("_corrupt is not null").collect()
    assert len(bad) == 1 and bad[0]["_corrupt"].startswith("{not json") and bad[0]["ticket_id"] is None
    # (Spark refuses queries that reference only the corrupt column, so read a real one too)
    assert len(rows.filter("_corrupt is null").select("ticket_id", "_corrupt").collect()) == 2
