"""Triage by a table of rules against the CASE form."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tierline.functions import rule_table
from tierline.functions.rule_table import with_rule_table
from tierline.functions.triage import DEFAULT_OUTCOME, DEFAULT_RULES, Outcome, Rule, with_triage

SCHEMA = "rule_order long, keyword string, sentiment string, urgency_score int, summary string"


def as_rows(spark, rules):
    return spark.createDataFrame(
        [(i, k, r.outcome.sentiment, r.outcome.urgency_score, r.outcome.summary) for i, r in enumerate(rules) for k in r.keywords],
        SCHEMA)


def result(df):
    return sorted(((r["i"], tuple(r["triage"]) if r["triage"] else None) for r in df.collect()), key=repr)


def test_thousand_keywords_equal_the_case_form(spark):
    pick = random.Random(3)
    words = ["".join(pick.choice("abcdÉß") for _ in range(pick.randint(3, 7))) for _ in range(1000)]
    rules = tuple(Rule(tuple(words[i:i + 5]), Outcome("Negative", i % 4, f"rule {i}")) for i in range(0, 1000, 5))
    texts = ["".join(pick.choice("abcdÉßABC xyz") for _ in range(pick.randint(0, 60))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "", words[7].upper()])], "i int, t string")
    got = result(with_rule_table(df, "t", as_rows(spark, rules)))
    # The CASE form, in slices of the rules, the first slice with a match wins.
    want = {r["i"]: None for r in df.collect()}
    for i in range(0, len(rules), 40):
        for r in with_triage(df, "t", rules=rules[i:i + 40], default=Outcome("none", -1, "")).collect():
            if want[r["i"]] is None and r["triage"] is not None and r["triage"]["sentiment"] != "none":
                want[r["i"]] = tuple(r["triage"])
    default = (DEFAULT_OUTCOME.sentiment, DEFAULT_OUTCOME.urgency_score, DEFAULT_OUTCOME.summary)
    texts_by_id = {r["i"]: r["t"] for r in df.collect()}
    want = sorted(((i, w or (default if texts_by_id[i] is not None else None)) for i, w in want.items()), key=repr)
    assert got == want and len({t for _, t in got}) > 50


def test_default_rules_as_rows(spark):
    df = spark.createDataFrame([(0, "It broke, delayed"), (1, "DELAYED"), (2, "bodies"), (3, None), (4, "fine"), (5, "")],
                               "i int, t string")
    assert result(with_rule_table(df, "t", as_rows(spark, DEFAULT_RULES))) == result(with_triage(df, "t"))


def test_overlapping_keywords_and_odd_rules(spark):
    outcome = Outcome("Negative", 1, "x")
    rules = as_rows(spark, (Rule(("abcd",), outcome), Rule(("bc",), outcome), Rule(("zabcdz",), outcome)))
    odd = spark.createDataFrame([(None, "q", "n", 1, "n"), (9, None, "n", 1, "n"), (1, "bc", "Negative", 1, "a")], SCHEMA)
    df = spark.createDataFrame([(0, "zabcdz"), (1, "xbcx"), (2, "q")], "i int, t string")
    got = dict(result(with_rule_table(df, "t", rules.unionByName(odd))))
    assert got[0] == ("Negative", 1, "x") and got[1] == ("Negative", 1, "a") and got[2][0] == DEFAULT_OUTCOME.sentiment
    everything = spark.createDataFrame([(5, "", "Neutral", 2, "any")], SCHEMA)
    got = dict(result(with_rule_table(df, "t", rules.unionByName(everything))))
    assert got[0][0] == "Negative" and got[2] == ("Neutral", 2, "any")
    assert dict(result(with_rule_table(df, "t", rules.limit(0))))[0][0] == DEFAULT_OUTCOME.sentiment


def test_cost_does_not_grow_with_the_keywords(spark):
    pick = random.Random(5)
    texts = spark.range(4000).select(F.col("id").cast("int").alias("i"), F.repeat(F.lit("plain words of a ticket "), 100).alias("t"))

    def seconds(n):
        words = ["".join(pick.choice("abcdefghijklmnop") for _ in range(9)) + "!" for _ in range(n)]
        rules = as_rows(spark, tuple(Rule((w,), DEFAULT_OUTCOME) for w in words))
        best = []
        for _ in range(3):
            start = time.perf_counter()
            with_rule_table(texts, "t", rules).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    assert seconds(2000) < 5 * seconds(20) + 1


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(rule_table, "MAX_RULES", 3)
    df = spark.createDataFrame([(0, "x")], "i int, t string")
    with pytest.raises(ValueError):
        with_rule_table(df, "t", as_rows(spark, DEFAULT_RULES))
