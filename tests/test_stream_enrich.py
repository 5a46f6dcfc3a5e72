"""Streams joined with a changing dimension, and hot keys learnt on the way."""

import glob
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import write_text
from tierline.plans.silver import run_silver_events
from tierline.schemas import RAW_EVENT
from tierline.sources.files import event_json_stream
from tierline.streaming.enrich import HotKeys, enrich_each_batch
from tierline.streaming.runner import batch_count, run_available_now


def land(workdir, name, users):
    lines = [json.dumps({"event_id": f"{name}-{i}", "user_id": u, "event_type": "click", "timestamp": "2026-01-02T03:04:05Z",
                         "payload": "{}"}) for i, u in enumerate(users)]
    write_text(f"{workdir}/ev", f"{name}.json", "\n".join(lines))


def dimension(spark, workdir, version, users):
    spark.createDataFrame([(u, version) for u in users], "user_id string, version string") \
        .write.mode("overwrite").parquet(f"{workdir}/dim")


def run(spark, workdir, **options):
    stream = event_json_stream(spark, f"{workdir}/ev", RAW_EVENT, max_files_per_trigger=options.pop("files", 100))
    return enrich_each_batch(stream, lambda: spark.read.parquet(f"{workdir}/dim"), "user_id", f"{workdir}/out",
                             f"{workdir}/ck", **options)


@pytest.mark.parametrize("options", [{}, {"broadcast_max_rows": 100}, {"salt_buckets": 4, "hot_share": 0.2}])
def test_each_row_meets_the_version_of_its_batch(spark, workdir, options):
    for n, users in enumerate((["1", "2"], ["1"], ["1", "3"])):
        land(workdir, f"load{n}", ["1", "2", "3", None])
        dimension(spark, workdir, f"v{n}", users)
        run(spark, workdir, **options)
    run(spark, workdir, **options)  # nothing new
    got = sorted((r["event_id"], r["user_id"], r["version"]) for r in spark.read.parquet(f"{workdir}/out").collect())
    want = []
    for n, users in enumerate((["1", "2"], ["1"], ["1", "3"])):
        want += [(f"load{n}-{i}", u, f"v{n}" if u in users else None) for i, u in enumerate(["1", "2", "3", None])]
    assert got == sorted(want)


def test_a_repeated_key_fails_its_batch_which_runs_again(spark, workdir):
    land(workdir, "a", ["1", "2"])
    dimension(spark, workdir, "v0", ["1", "1"])
    with pytest.raises(StreamingQueryException):
        run(spark, workdir)
    dimension(spark, workdir, "v1", ["1"])
    run(spark, workdir)
    got = sorted((r["user_id"], r["version"]) for r in spark.read.parquet(f"{workdir}/out").collect())
    assert got == [("1", "v1"), ("2", None)]


def test_dimension_outgrows_the_broadcast_between_batches(spark, workdir, monkeypatch):
    from tierline.operators import enrich
    plans = []
    real = enrich.left_enrich

    def noted(*args, **kwargs):
        out = real(*args, **kwargs)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr("tierline.streaming.enrich.left_enrich", noted)
    for n, users in enumerate((["1"], ["1", "2", "3"])):
        land(workdir, f"load{n}", ["1", "2"])
        dimension(spark, workdir, f"v{n}", users)
        run(spark, workdir, broadcast_max_rows=2)
    assert ["strategy=broadcast" in p for p in plans] == [True, False]


def test_sketch_names_the_hot_keys_of_all_batches(spark, workdir):
    keys = HotKeys(spark, f"{workdir}/hot", "k", 0.1)
    frame = lambda counts: spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "k long")
    names = lambda hot: sorted(r["k"] for r in hot.collect())
    cold = {i: 1 for i in range(100, 160)}
    assert names(keys.update(frame({1: 30, 2: 5} | cold), 0)) == [1]
    assert names(keys.update(frame({2: 40} | cold), 1)) == [1, 2]
    assert names(keys.update(frame({2: 40} | cold), 1)) == [1, 2]  # a replay counts once
    hot = keys.update(frame({3: 400}), 2)
    assert names(hot) == [3] and hot.schema["k"].dataType.typeName() == "long"
    assert names(keys.update(spark.createDataFrame([], "k long"), 3)) == [3]
    assert names(keys.update(spark.createDataFrame([(None,)] * 900, "k long"), 4)) == [3]
    assert len(glob.glob(f"{workdir}/hot/slot=*")) == 2


def test_a_hot_user_is_spread_over_tasks(spark, workdir):
    for n in range(3):
        land(workdir, f"load{n}", ["hot" if i % 2 else f"u{n}-{i}" for i in range(4000)])
    dimension(spark, workdir, "v", ["hot", "u0-0"])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        query = run(spark, workdir, files=1, salt_buckets=16, hot_share=0.1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert batch_count(query) >= 3
    out = spark.read.parquet(f"{workdir}/out")
    assert out.count() == 12_000 and out.filter("version = 'v'").count() == 6_001
    per_task = out.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_task < 4000 / 3  # half of a batch of 4,000 has one key


def test_silver_events_with_a_changing_dimension(spark, workdir):
    for n in range(2):
        land(workdir, f"load{n}", ["1", None])
        dimension(spark, workdir, f"v{n}", ["1"])
        run_silver_events(spark, f"{workdir}/ev", lambda: spark.read.parquet(f"{workdir}/dim"), f"{workdir}/silver",
                          f"{workdir}/ck", rejects=f"{workdir}/rejects", broadcast_max_rows=10, snapshot=True)
    rows = spark.read.parquet(f"{workdir}/silver")
    assert sorted((r["user_id"] or "", r["version"] or "") for r in rows.collect()) == [("", ""), ("", ""), ("1", "v0"), ("1", "v1")]
    assert rows.filter("event_timestamp is null or ingestion_timestamp is null").count() == 0


def test_batches_by_bytes_are_even(spark, workdir):
    land(workdir, "large", ["1"] * 400)
    for i in range(20):
        land(workdir, f"small{i:02}", ["1"] * 40)
    size = sum(len(open(f).read()) for f in glob.glob(f"{workdir}/ev/*.json"))
    stream = event_json_stream(spark, f"{workdir}/ev", RAW_EVENT, max_bytes_per_trigger=size // 3)
    query = run_available_now(stream, f"{workdir}/o", f"{workdir}/c")
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(sizes) == 1200 and len(sizes) >= 3 and max(sizes) <= 440
    assert spark.read.parquet(f"{workdir}/o").count() == 1200
