import datetime as dt

import pytest

from tierline.operators.columns import assert_fits, drop_columns, parse_timestamp, stamp
from tierline.operators.keys import assert_unique, key_rejects, require_key, split_by_key


def test_lenient_timestamp(spark):
    df = spark.createDataFrame([("2026-01-02T03:04:05Z",), ("bad",), (None,)], "timestamp string")
    got = [r[0] for r in parse_timestamp(df).collect()]
    assert got == [dt.datetime(2026, 1, 2, 3, 4, 5), None, None]
    assert parse_timestamp(df).columns == ["event_timestamp"]
    assert parse_timestamp(df, keep_raw=True).columns == ["timestamp", "event_timestamp"]


def test_require_key_and_rejects(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("a", 3)], "event_id string, n int")
    kept, rejects = split_by_key(df, "event_id")
    assert sorted(r["n"] for r in kept.collect()) == [2, 3]
    rej = rejects.collect()
    assert [(r["n"], r["reject_reason"]) for r in rej] == [(1, "missing event_id")]
    assert require_key(df, "event_id").count() + key_rejects(df, "event_id").count() == df.count()


def test_unique_and_bounds(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(ValueError):
        assert_unique(df, "k")
    with pytest.raises(ValueError):
        assert_fits(spark.createDataFrame([("x" * 300,)], "product_id string"), {"product_id": 255})
    assert_fits(spark.createDataFrame([("x" * 255,)], "product_id string"), {"product_id": 255})


def test_stamp_and_drop(spark):
    df = spark.createDataFrame([(1, "t")], "a int, timestamp string")
    out = drop_columns(stamp(df), "timestamp", "absent")
    assert out.columns == ["a", "ingested_at"]
    assert out.collect()[0]["ingested_at"] is not None


def test_fingerprint_is_order_insensitive(spark):
    from tierline.operators.fingerprint import fingerprint, same_rows
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x"), (2, "y")], "k int, v string").repartition(3)
    c = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert same_rows(a, b) and not same_rows(a, c)
    assert fingerprint(a)[0] == 3
