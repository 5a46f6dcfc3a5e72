"""Compaction of tables that streams append to."""

import glob
import json
import os

import pyarrow.parquet as pq

import __spark_entry__
from helpers import write_text
from tierline.cli import dispatch, parser
from tierline.plans.bronze import run_bronze
from tierline.session import LISTING_TASKS, file_stream
from tierline.streaming.compact import run_compaction


def land(workdir, names):
    for n in names:
        write_text(f"{workdir}/landing", f"{n}.json", json.dumps([{"ticket_id": f"T{n}-{i}", "review_text": "x" * 50} for i in range(3)]))


def ids(spark, path):
    return sorted(r["ticket_id"] for r in spark.read.parquet(path).select("ticket_id").collect())


def files(path):
    return glob.glob(f"{path}/**/part-*.parquet", recursive=True)


def rows_in(path):
    return pq.read_metadata(path).num_rows


def compact(spark, workdir, **options):
    bronze = f"{workdir}/bronze"
    return run_compaction(spark, bronze, f"{workdir}/large", f"{workdir}/ck-large", spark.read.parquet(bronze).schema, **options)


def test_many_small_files_become_few(spark, workdir):
    for load in (range(12), range(12, 20)):
        land(workdir, load)
        run_bronze(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ck", max_files_per_trigger=2)
        compact(spark, workdir)
        assert ids(spark, f"{workdir}/large") == ids(spark, f"{workdir}/bronze")
    compact(spark, workdir)  # nothing new
    assert len(ids(spark, f"{workdir}/large")) == 60
    assert len(files(f"{workdir}/bronze")) >= 10 and len(files(f"{workdir}/large")) == 2


def test_files_have_about_the_target_size(spark, workdir):
    rows = spark.range(40_000).selectExpr("cast(id as string) as ticket_id", "sha2(cast(id as string), 256) as review_text")
    rows.repartition(40).write.parquet(f"{workdir}/bronze")
    total = sum(map(os.path.getsize, files(f"{workdir}/bronze")))
    compact(spark, workdir, target_bytes=total // 5)
    sizes = [os.path.getsize(f) for f in files(f"{workdir}/large")]
    assert len(sizes) == 5 and min(sizes) > total // 10 and max(sizes) < total // 2
    assert ids(spark, f"{workdir}/large") == sorted(str(i) for i in range(40_000))


def test_a_batch_that_fails_runs_again_once(spark, workdir):
    land(workdir, range(4))
    run_bronze(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ck")
    os.makedirs(f"{workdir}/large/batch=0")  # what a failed attempt left behind
    spark.read.parquet(f"{workdir}/bronze").write.mode("overwrite").parquet(f"{workdir}/large/batch=0")
    compact(spark, workdir)
    assert len(ids(spark, f"{workdir}/large")) == 12


def test_compact_job_and_missing_source(spark, workdir):
    land(workdir, range(3))
    run_bronze(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ck")
    args = ["compact", "--source", f"{workdir}/bronze", "--out", f"{workdir}/large", "--checkpoint", f"{workdir}/ck-large"]
    assert dispatch(spark, parser().parse_args(args)) == 0
    assert len(ids(spark, f"{workdir}/large")) == 9
    schema = spark.read.parquet(f"{workdir}/bronze").schema
    assert run_compaction(spark, f"{workdir}/none", f"{workdir}/o", f"{workdir}/c", schema) is None


def test_listing_takes_few_tasks_however_many_files(spark, workdir):
    """A task for each of 300 files before."""
    land(workdir, range(300))
    query = run_bronze(spark, f"{workdir}/landing", f"{workdir}/bronze", f"{workdir}/ck")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(job).stageIds]
    tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    assert tasks and max(tasks) <= LISTING_TASKS
    assert len(ids(spark, f"{workdir}/bronze")) == 900


def test_a_listing_number_of_the_session_stays(spark):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    held = spark.conf.get(name)
    try:
        for own, then in (("7", "7"), ("10000", str(LISTING_TASKS))):
            spark.conf.set(name, own)
            file_stream(spark)
            assert spark.conf.get(name) == then
    finally:
        spark.conf.set(name, held)


def test_bronze_compacted_lands_few_files_and_keeps_bronze_files_small(spark, workdir, monkeypatch):
    """4,000 documents came as 400 landing files before; a bronze file still
    holds no more than one landing file, and the session's setting is put back."""
    schema = "doc_id long, source string, lang string, text string, n_chars long"
    docs = [(i, f"s{i % 3}", ("en", "de", None)[i % 3], f"text {i} " * 5, 40) for i in range(4000)]
    spark.createDataFrame(docs, schema).coalesce(1).write.parquet(f"{workdir}/documents.parquet")
    monkeypatch.setattr("tierline.registry.scratch_path", lambda spark, name: f"{workdir}/{name}")
    held = spark.conf.get("spark.sql.files.openCostInBytes")
    rows = __spark_entry__.queries()["bronze_compacted"](spark, workdir)
    assert sorted(r["ticket_id"] for r in rows.collect()) == sorted(f"DOC-{i}" for i in range(4000))
    landed = glob.glob(f"{workdir}/bronze-compacted/landing/part-*")
    small = [n for n in map(rows_in, files(f"{workdir}/bronze-compacted/bronze")) if n]
    assert 16 <= len(landed) <= 40 and len(small) >= len(landed) and max(small) <= 320
    assert len(files(f"{workdir}/bronze-compacted/compacted")) == 2
    assert spark.conf.get("spark.sql.files.openCostInBytes") == held
