"""Property tests: Spark operators against plain-Python statements of their
semantics, on generated inputs (one Spark job per generated case)."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierline.functions.triage import DEFAULT_OUTCOME, DEFAULT_RULES, with_triage
from tierline.sinks.landing import landing_arrays
from tierline.sinks.snapshots import upsert

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

WORDS = ["battery", "Dies", "BROKE", "broken", "bodies", "confusing", "delayed", "fine", "great", "ok", "x"]
text = st.one_of(
    st.none(),
    st.lists(st.sampled_from(WORDS), max_size=8).map(" ".join),
    st.text(alphabet="abcdeyioukrnstlBCDEÄé ", max_size=40),
)


def expected_triage(t):
    if t is None:
        return (None, None)
    low = t.lower()
    for rule in DEFAULT_RULES:
        if any(k in low for k in rule.keywords):
            return (rule.outcome.sentiment, rule.outcome.urgency_score)
    return (DEFAULT_OUTCOME.sentiment, DEFAULT_OUTCOME.urgency_score)


@SETTINGS
@given(st.lists(text, min_size=1, max_size=60))
def test_triage_matches_rule_semantics(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [(r["sentiment"], r["urgency_score"]) for r in with_triage(df, "t", flatten=True).orderBy("i").collect()]
    assert got == [expected_triage(t) for t in texts]


keys = st.sampled_from([f"P{i}" for i in range(12)])


@SETTINGS
@given(st.dictionaries(keys, st.integers(0, 99), max_size=10),
       st.dictionaries(keys, st.integers(100, 199), max_size=10))
def test_upsert_is_a_dictionary_merge(spark, target, staged):
    t = spark.createDataFrame(list(target.items()) or [], "product_id string, total_reviews long")
    s = spark.createDataFrame(list(staged.items()) or [], "product_id string, total_reviews long")
    for bound in (None, 100):
        merged = upsert(t, s, "product_id", stamp=None, broadcast_max_rows=bound)
        out = {r["product_id"]: r["total_reviews"] for r in merged.collect()}
        assert out == {**target, **staged}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**6), st.text(max_size=30)), min_size=1, max_size=80),
       st.integers(1, 9))
def test_landing_arrays_keep_every_record(spark, rows, per_file):
    df = spark.createDataFrame(rows, "id long, body string").repartition(3)
    arrays = [json.loads(a[0]) for a in landing_arrays(df, per_file).collect()]
    assert all(1 <= len(a) <= per_file for a in arrays)
    back = sorted((r["id"], r["body"]) for a in arrays for r in a)
    assert back == sorted(rows)


maybe_key = st.one_of(st.none(), st.text(alphabet="ab", max_size=3))


@SETTINGS
@given(st.lists(st.tuples(maybe_key, st.integers(-2**63, 2**63 - 1)), max_size=50))
def test_keys_split_rows_exactly(spark, rows):
    from tierline.operators.keys import split_by_key
    df = spark.createDataFrame(rows or [], "k string, v long")
    kept, rejects = split_by_key(df, "k")
    got_kept = sorted((r["k"], r["v"]) for r in kept.collect())
    got_rej = sorted(r["v"] for r in rejects.collect())
    assert got_kept == sorted((k, v) for k, v in rows if k is not None)
    assert got_rej == sorted(v for k, v in rows if k is None)


stamps = st.one_of(
    st.none(),
    st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2100, 1, 1)).map(
        lambda d: d.replace(microsecond=0).strftime("%Y-%m-%dT%H:%M:%SZ")),
    st.text(alphabet="0123456789-:TZ /", max_size=20),
)


@SETTINGS
@given(st.lists(stamps, min_size=1, max_size=40))
def test_lenient_parse_never_raises_and_round_trips_iso(spark, texts):
    from tierline.functions.timefmt import iso_text
    from tierline.operators.columns import parse_timestamp
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, timestamp string")
    # only text and a null flag come back to Python (Spark accepts years Python cannot hold, e.g. "0000")
    parsed = parse_timestamp(df, keep_raw=True)
    out = parsed.select("i", "timestamp", iso_text("event_timestamp").alias("back"),
                        parsed["event_timestamp"].isNull().alias("is_null")).orderBy("i").collect()
    for r in out:
        t = r["timestamp"]
        iso = t is not None and len(t) == 20 and t.endswith("Z") and t[10] == "T"
        if iso:
            try:
                dt.datetime.strptime(t, "%Y-%m-%dT%H:%M:%SZ")
            except ValueError:
                iso = False
        if iso:
            assert r["back"] == t
        elif t is None:
            assert r["is_null"]
