from pyspark.sql import functions as F

from tierline.functions.triage import (
    DEFAULT_RULES, parse_triage_json, to_triage_json, triage, with_triage,
)
from tierline.sources.synthetic import OPENINGS, VERDICTS, tickets_from_rows


def _triage(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = with_triage(df, "text", flatten=True).orderBy("i").collect()
    return [(r["sentiment"], r["urgency_score"]) for r in rows]


def test_generated_reviews_fire_every_rule(spark):
    tickets = tickets_from_rows(spark.range(2000), "id", None)
    rows = with_triage(tickets.select("review_text"), "review_text", flatten=True).distinct().collect()
    outcomes = {(r["sentiment"], r["urgency_score"]) for r in rows}
    assert outcomes == {("Negative", 5), ("Negative", 3), ("Positive", 1)}
    for r in rows:
        expected = next((rule.outcome for rule in DEFAULT_RULES if any(k in r["review_text"] for k in rule.keywords)), None)
        assert r["urgency_score"] == (expected.urgency_score if expected else 1)
    assert len(rows) >= 5 * len(VERDICTS) > len(OPENINGS)


def test_substring_case_order_and_null(spark):
    got = _triage(spark, ["Dead bodies everywhere", "It is BROKEN", "confusing and the battery",
                          "delayed", None, ""])
    assert got == [("Negative", 5), ("Negative", 5), ("Negative", 5),
                   ("Negative", 3), (None, None), ("Positive", 1)]


def test_summaries_are_fixed(spark):
    df = spark.createDataFrame([("battery",), ("delayed",), ("fine",)], "t string")
    got = [r[0] for r in df.select(triage("t")["summary"]).collect()]
    assert got == [r.outcome.summary for r in DEFAULT_RULES] + [
        "User satisfaction loop: General positive sentiment captured."]


def test_json_round_trip(spark):
    df = spark.createDataFrame([("battery",), (None,)], "t string")
    js = [r[0] for r in df.select(to_triage_json(triage("t"))).collect()]
    assert js[0] == ('{"sentiment":"Negative","urgency_score":5,'
                     '"summary":"Hardware failure flag: Product reporting physical breakdown."}')
    assert js[1] is None
    bad = spark.createDataFrame([("not json",), (None,), (js[0],)], "j string")
    parsed = [r[0] for r in bad.select(parse_triage_json(F.col("j"))).collect()]
    assert tuple(parsed[0]) == (None, None, None)
    assert parsed[1] is None
    assert parsed[2]["urgency_score"] == 5


def test_lowercase_computed_once(spark):
    df = spark.createDataFrame([("x",)], "text string")
    plan = with_triage(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
