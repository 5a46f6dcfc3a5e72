"""Rule-based text triage as Spark column expressions.

A rule list is compiled into one ``CASE WHEN`` over a lower-cased copy of the
text: ordered rules, first match wins, each rule fires when any of its
keywords occurs as a substring (not a whole word: "bodies" matches "dies").
Everything stays inside the JVM, so the rule chain is fused by whole-stage
codegen and no Python worker is involved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TRIAGE, TRIAGE_DDL


@dataclass(frozen=True)
class Outcome:
    sentiment: str
    urgency_score: int
    summary: str


@dataclass(frozen=True)
class Rule:
    keywords: tuple[str, ...]
    outcome: Outcome


# --- Fixed values: keywords, labels, scores and summaries of the triage rules.
# They must equal the reference's output exactly.
HARDWARE = Outcome(
    "Negative", 5, "Hardware failure flag: Product reporting physical breakdown."
)
FRICTION = Outcome(
    "Negative", 3, "Operational friction flag: Experiencing setup or logistic delays."
)
SATISFIED = Outcome(
    "Positive", 1, "User satisfaction loop: General positive sentiment captured."
)
DEFAULT_RULES = (
    Rule(("battery", "dies", "broke"), HARDWARE),
    Rule(("confusing", "delayed"), FRICTION),
)
DEFAULT_OUTCOME = SATISFIED
# --- end of fixed values


def _outcome_struct(outcome: Outcome) -> Column:
    return F.struct(
        F.lit(outcome.sentiment).alias("sentiment"),
        F.lit(outcome.urgency_score).cast("int").alias("urgency_score"),
        F.lit(outcome.summary).alias("summary"),
    )


def _any_keyword(lowered: Column, keywords: tuple[str, ...]) -> Column:
    cond = None
    for kw in keywords:
        hit = lowered.contains(kw.lower())
        cond = hit if cond is None else (cond | hit)
    return cond if cond is not None else F.lit(False)


def triage_expr(
    lowered: Column,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: Outcome = DEFAULT_OUTCOME,
) -> Column:
    """Struct ``(sentiment, urgency_score, summary)`` for already lower-cased text.

    Null text gives a null result instead of falling through to the default.
    """
    expr = F.when(lowered.isNull(), F.lit(None).cast(TRIAGE))
    for rule in rules:
        expr = expr.when(_any_keyword(lowered, rule.keywords), _outcome_struct(rule.outcome))
    return expr.otherwise(_outcome_struct(default))


def triage(
    text: Column | str,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: Outcome = DEFAULT_OUTCOME,
) -> Column:
    """Triage struct for raw text (lower-cases inline)."""
    col = F.col(text) if isinstance(text, str) else text
    return triage_expr(F.lower(col), rules, default)


def with_triage(
    df: DataFrame,
    text: str,
    out: str = "triage",
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: Outcome = DEFAULT_OUTCOME,
    flatten: bool = False,
) -> DataFrame:
    """Add the triage of column ``text``.

    The lower-cased copy is projected once and shared by every keyword test
    (Catalyst does not collapse a non-trivial alias that is referenced more
    than once, so each long text is lower-cased a single time).
    """
    tmp = f"__{out}_lc"
    staged = df.withColumn(tmp, F.lower(F.col(text)))
    staged = staged.withColumn(out, triage_expr(F.col(tmp), rules, default)).drop(tmp)
    if flatten:
        staged = staged.select(
            *[c for c in staged.columns if c != out],
            F.col(f"{out}.sentiment").alias("sentiment"),
            F.col(f"{out}.urgency_score").alias("urgency_score"),
            F.col(f"{out}.summary").alias("summary"),
        )
    return staged


def to_triage_json(triage_struct: Column) -> Column:
    """JSON text with key order sentiment, urgency_score, summary (compact)."""
    return F.to_json(triage_struct)


def parse_triage_json(json_text: Column) -> Column:
    """Parse triage JSON back into the struct; malformed text gives a struct of
    nulls, null gives null."""
    return F.from_json(json_text, TRIAGE_DDL)
