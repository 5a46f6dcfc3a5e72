"""The whole ticket chain in order: landing -> bronze -> silver -> gold.

Each step drains what is available and stops (``availableNow``), so the next
step starts only after the previous one finished; the first failure is
raised and stops the chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..functions.triage import DEFAULT_OUTCOME, DEFAULT_RULES, Outcome, Rule
from ..schemas import TICKET
from ..streaming.runner import BATCH_FILES
from ..sinks.target import target_exists
from .bronze import run_bronze
from .gold import GoldResult, run_gold, run_gold_incremental
from .silver import run_silver_tickets, silver_tickets, BRONZE_TICKET


@dataclass(frozen=True)
class ChainPaths:
    landing: str
    bronze: str
    silver: str
    gold: str
    checkpoints: str
    rejects: str | None = None
    silver_rejects: str | None = None

    @classmethod
    def under(cls, root: str, landing: str | None = None) -> "ChainPaths":
        root = root.rstrip("/")
        return cls(
            landing=landing or f"{root}/landing",
            bronze=f"{root}/bronze",
            silver=f"{root}/silver",
            gold=f"{root}/gold",
            checkpoints=f"{root}/checkpoints",
            rejects=f"{root}/rejects",
            silver_rejects=f"{root}/silver_rejects",
        )


def silver_schema(spark: SparkSession, rules: tuple[Rule, ...], default: Outcome):
    """Schema of silver tickets, derived from the transform itself."""
    return silver_tickets(spark.createDataFrame([], BRONZE_TICKET), rules, default).schema


def run_chain(
    spark: SparkSession,
    paths: ChainPaths,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: Outcome = DEFAULT_OUTCOME,
    max_files_per_trigger: int | None = BATCH_FILES,
    incremental: bool = False,
) -> GoldResult:
    """Bronze, silver, then gold: a full recomputation over silver (the
    reference's semantics), or with ``incremental`` a streaming aggregation
    that only reads silver files added since the last run."""
    run_bronze(
        spark, paths.landing, paths.bronze, f"{paths.checkpoints}/bronze",
        schema=TICKET, max_files_per_trigger=max_files_per_trigger,
    )
    run_silver_tickets(
        spark, paths.bronze, paths.silver, f"{paths.checkpoints}/silver", rules, default,
        rejects=paths.silver_rejects, rejects_checkpoint=f"{paths.checkpoints}/silver_rejects",
    )
    schema = silver_schema(spark, rules, default)
    if not incremental:
        return run_gold(spark, paths.silver, paths.gold, schema, paths.rejects)
    run_gold_incremental(
        spark, paths.silver, paths.gold, f"{paths.checkpoints}/gold", schema, paths.rejects,
    )
    return GoldResult(paths.gold if target_exists(spark, paths.gold) else None, None, None)
