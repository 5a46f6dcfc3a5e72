import json
import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import write_text
from tierline.functions.timefmt import epoch_seconds, iso_text
from tierline.plans.bronze import run_bronze
from tierline.sources.jdbc import jdbc_options
from tierline.sources.synthetic import PRODUCTS, tickets_from_rows
from tierline.streaming.runner import processing_time


def test_jdbc_options():
    opts = jdbc_options("jdbc:postgresql://h:5432/db", "public.user_metadata", user="u", password="p",
                        driver="org.postgresql.Driver", partition_column="user_id", lower_bound=0,
                        upper_bound=1000, num_partitions=8, fetch_size=5000)
    assert opts["partitionColumn"] == "user_id" and opts["numPartitions"] == "8"
    assert opts["lowerBound"] == "0" and opts["upperBound"] == "1000" and opts["fetchsize"] == "5000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_generator_ids_and_picks(spark):
    rows = spark.range(2000).withColumn("t", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    fixed = tickets_from_rows(rows, "id", "t")
    again = tickets_from_rows(rows, "id", "t")
    assert fixed.exceptAll(again).count() == 0                     # repeatable
    r = fixed.agg(F.min("customer_id"), F.max("customer_id"), F.countDistinct("product_id"),
                  F.countDistinct("review_text"), F.first("timestamp")).collect()[0]
    assert r[0] >= "CUST-5000" and r[1] <= "CUST-9999"
    assert r[2] == len(PRODUCTS) and r[3] >= 40 and r[4] == "2026-01-02T03:04:05Z"
    rand = tickets_from_rows(rows, "id", "t", random_ids=True)
    assert rand.select(F.countDistinct("ticket_id")).collect()[0][0] == 2000


def test_epoch_and_iso(spark):
    df = spark.createDataFrame([("2026-01-02T03:04:05Z",)], "s string").select(
        F.col("s").try_cast("timestamp").alias("t"))
    r = df.select(epoch_seconds(F.col("t")), iso_text("t"), epoch_seconds()).collect()[0]
    assert r[0] == 1767323045 and r[1] == "2026-01-02T03:04:05Z" and abs(r[2] - time.time()) < 600


def test_processing_time_trigger_and_archive(spark, workdir):
    land, archive = f"{workdir}/landing", f"{workdir}/archive"
    tickets = [{"ticket_id": f"T{i}", "review_text": "ok"} for i in range(3)]
    write_text(land, "a.json", json.dumps(tickets))
    q = run_bronze(spark, land, f"{workdir}/bronze", f"{workdir}/ckpt", trigger=processing_time("1 second"),
                   source_options={"cleanSource": "archive", "sourceArchiveDir": archive})
    try:
        q.processAllAvailable()
        write_text(land, "b.json", json.dumps([{"ticket_id": "T9"}]))
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{workdir}/bronze").count() == 4
    archived = [f for _, _, files in os.walk(archive) for f in files]
    assert "a.json" in archived   # processed files leave the landing folder


def test_jdbc_write_checks_bounds_before_connecting(spark):
    from tierline.sources.jdbc import write_jdbc
    df = spark.createDataFrame([("P" * 300, 1)], "product_id string, total_reviews long")
    with pytest.raises(ValueError):
        # the URL is never contacted: the length check fails first
        write_jdbc(df, "jdbc:unreachable://nowhere/db", "gold", max_length={"product_id": 255})


def test_scratch_root_prefers_session_setting(spark):
    from tierline.session import scratch_path, scratch_root
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_stream_failure_is_raised(spark, workdir):
    from pyspark.errors import StreamingQueryException

    write_text(f"{workdir}/landing", "a.json", json.dumps([{"ticket_id": "T1"}]))
    write_text(workdir, "blocker", "a regular file where the bronze folder should go")
    with pytest.raises(Exception):  # refused at start
        run_bronze(spark, f"{workdir}/landing", f"{workdir}/blocker/bronze", f"{workdir}/ckpt")
    # a failure inside a micro-batch surfaces from drain
    from tierline.sources.files import landing_json_stream
    from tierline.streaming.runner import run_available_now
    bad = landing_json_stream(spark, f"{workdir}/landing").select(F.col("ticket_id").cast("int"))
    with pytest.raises(StreamingQueryException):
        run_available_now(bad, f"{workdir}/out", f"{workdir}/ck2")
