"""Triage by a table of rules: many keywords, one pass over each text.

The ``CASE WHEN`` of :mod:`tierline.functions.triage` searches a text once per
keyword, which is right for a handful. A table of rules compiles its keywords
into one automaton (Aho-Corasick) that finds every occurrence of any of them in
a single pass, so the cost per text does not grow with the number of keywords.
Semantics are the same: keywords are substrings of the lower-cased text, the
rule of lowest order with any keyword in the text wins, a null text has no
triage.

The keyword search is an Arrow-batched UDF over the text alone that returns the
order of the winning rule; outcomes are attached by a broadcast join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import fits_broadcast
from .triage import DEFAULT_OUTCOME, Outcome

# A rule table is configuration: it goes to the driver and to every task.
MAX_RULES = 1_000_000
MAX_BYTES = 128 * 1024 * 1024

OUTCOME = ("sentiment", "urgency_score", "summary")
ORDER = "__rule"


def first_rule(keywords: list[tuple[str, int]]):
    """A UDF: the lowest number among the keywords that a text contains, null
    if it contains none or is null."""

    @F.pandas_udf("long")
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, number in keywords:
            automaton.add_word(word, min(number, automaton.get(word, number)))
        if keywords:
            automaton.make_automaton()
        lowest = min((number for _, number in keywords), default=0)

        def best(text):
            if text is None or not keywords:
                return None
            found = None
            for _, number in automaton.iter(text):
                if found is None or number < found:
                    found = number
                    if found == lowest:
                        break
            return found

        for batch in texts:
            yield pd.Series([best(t) for t in batch], dtype="Int64")

    return search


def with_rule_table(
    df: DataFrame,
    text: str,
    rules: DataFrame,
    default: Outcome = DEFAULT_OUTCOME,
    out: str = "triage",
) -> DataFrame:
    """Add ``out``, the triage struct of column ``text`` by ``rules``: rows
    (rule_order, keyword, sentiment, urgency_score, summary), one per keyword.
    Rows of one order are one rule and must agree on its outcome; of several
    outcomes the smallest is taken. Null keywords and null orders are no
    rules; an empty keyword is in every text.

    Refuses a rule table above ``MAX_RULES`` rows or ``MAX_BYTES``.
    """
    known = rules.filter("keyword is not null and rule_order is not null").select(
        F.col("rule_order").cast("long").alias(ORDER), F.lower("keyword").alias("keyword"), *OUTCOME)
    if not fits_broadcast(known, MAX_RULES, MAX_BYTES):
        raise ValueError(f"a rule table of more than {MAX_RULES} rows or {MAX_BYTES} bytes")
    keywords = [(r["keyword"], r[ORDER]) for r in known.select("keyword", ORDER).distinct().collect()]
    always = min((n for word, n in keywords if not word), default=None)
    search = first_rule([(word, n) for word, n in keywords if word])
    outcomes = known.groupBy(ORDER).agg(F.min(F.struct(*OUTCOME)).alias(out))
    lowered: Column = F.lower(F.col(text))
    number = search(lowered)
    if always is not None:
        number = F.least(number, F.lit(always))
    numbered = df.withColumn(ORDER, F.when(F.col(text).isNotNull(), number))
    fallback = F.struct(F.lit(default.sentiment).alias("sentiment"),
                        F.lit(default.urgency_score).cast("int").alias("urgency_score"),
                        F.lit(default.summary).alias("summary"))
    joined = numbered.join(F.broadcast(outcomes), ORDER, "left")
    triage = F.when(F.col(text).isNotNull(), F.coalesce(F.col(out), fallback))
    return joined.select(*[F.col(c) for c in df.columns], triage.alias(out))
