"""Silver -> gold -> keyed target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.gold import product_metrics
from ..operators.keys import split_by_key
from ..schemas import GOLD_DEFAULTS, GOLD_KEY, GOLD_MAX_LENGTH, GOLD_STAMP, GOLD_TARGET
from ..sinks.snapshots import evolve, upsert
from ..sinks.target import merge_target, read_target
from ..session import file_stream, materialize
from ..sources.files import read_parquet_guarded
from ..sources.jdbc import write_jdbc
from ..streaming.runner import AVAILABLE_NOW, BATCH_FILES, Streams, start_append
from .silver import gold_input


@dataclass
class GoldResult:
    """``path`` is the target that the run merged into, None if there was
    nothing to do; it is read with ``sinks.target.read_target``."""

    path: str | None
    staged: DataFrame | None
    rejects: DataFrame | None


def gold_staged(silver: DataFrame) -> DataFrame:
    """Per product: counts, mean urgency, rounded rating, sentiment counts."""
    return product_metrics(gold_input(silver), sentiment="sentiment", rating=True)


# Partition column of the deltas of a drain.
BATCH = "batch"

# Staged products up to this many are merged without shuffling the target.
UPSERT_BROADCAST_ROWS = 5_000_000


def merge_into_target(
    target: DataFrame, staged: DataFrame, broadcast_max_rows: int | None = UPSERT_BROADCAST_ROWS
) -> DataFrame:
    """Upsert ``staged`` into ``target`` and conform to the gold schema.

    ``staged`` comes from a group-by on the key with null keys split off, so
    its keys are unique and present by construction.
    """
    current = evolve(target, GOLD_TARGET, GOLD_DEFAULTS, keep_extra=True)
    merged = upsert(current, staged, GOLD_KEY, GOLD_STAMP, GOLD_DEFAULTS, validate=False,
                    broadcast_max_rows=broadcast_max_rows)
    return evolve(merged, GOLD_TARGET, GOLD_DEFAULTS, now_columns=(GOLD_STAMP,))


def run_gold(
    spark: SparkSession,
    silver: str | list[str],
    target_root: str,
    silver_schema: StructType,
    rejects_path: str | None = None,
) -> GoldResult:
    """Aggregate silver tickets and merge them into the target.

    Missing or empty silver is "nothing to do": the target stays as it is.
    Tickets without a product cannot be keyed; they go to ``rejects_path``
    one by one, with the reason. The per-product aggregate is
    materialized once (it is small: one row per product) and feeds the upsert.
    """
    rows = read_parquet_guarded(spark, silver, silver_schema)
    keyed, rejects = split_by_key(rows, GOLD_KEY)
    staged = materialize(gold_staged(keyed), "gold-staged")
    if rejects_path and not rows.isEmpty():
        rejects.write.mode("overwrite").parquet(rejects_path)
    if staged.isEmpty():
        return GoldResult(None, None, rejects)
    merge_target(staged, target_root, GOLD_KEY, merge_into_target, GOLD_TARGET)
    return GoldResult(target_root, staged, rejects)


def run_gold_incremental(
    spark: SparkSession,
    silver: str,
    target_root: str,
    checkpoint: str,
    silver_schema: StructType,
    rejects_path: str | None = None,
    trigger: dict | None = AVAILABLE_NOW,
    max_files_per_trigger: int | None = BATCH_FILES,
) -> Streams | None:
    """Gold maintained incrementally from a stream of silver files.

    A streaming aggregation keeps per-product state (count, sum, sentiment
    counts) in the state store under ``checkpoint``; partial aggregation runs
    before the shuffle as in batch. Each micro-batch emits only the products
    it touched, with their full totals (update mode). A drain writes them as
    small deltas, merges the newest row of each product into the target once,
    at its end, and removes the deltas, so a backlog of many micro-batches
    rewrites each touched bucket of the target once. Deltas that a failed run
    left behind are merged by the next: totals only grow newer, so merging a
    delta again changes nothing. With a continuous trigger every micro-batch is
    merged at once, without deltas.

    Tickets without a product are appended to ``rejects_path`` one by one by a
    second stream. A silver folder that does not exist yet is "nothing to do"
    (returns None).
    """
    reader = file_stream(spark).schema(silver_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    try:
        rows = reader.parquet(silver)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    keyed, rejects = split_by_key(rows, GOLD_KEY)
    deltas = f"{checkpoint.rstrip('/')}-deltas"
    drains = bool(trigger and trigger.get("availableNow"))
    _merge_deltas(spark, deltas, target_root)  # of a run that failed

    def keep_batch(batch: DataFrame, batch_id: int) -> None:
        if drains:
            batch.write.mode("overwrite").parquet(f"{deltas}/{BATCH}={batch_id}")
        else:
            merge_target(materialize(batch, "gold-batch"), target_root, GOLD_KEY, merge_into_target, GOLD_TARGET)

    writer = (
        gold_staged(keyed).writeStream.outputMode("update")
        .foreachBatch(keep_batch)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    streams = Streams(writer.start())
    if rejects_path:
        streams.add(lambda: start_append(rejects, rejects_path, f"{checkpoint.rstrip('/')}-rejects", trigger))
    if drains:
        streams.drain()
        _merge_deltas(spark, deltas, target_root)
    return streams


def _merge_deltas(spark: SparkSession, deltas: str, target_root: str) -> None:
    """Merge the newest row of each product that waits as a delta, then remove
    the deltas: an overwrite by no rows leaves no batch folder."""
    schema = StructType([*gold_staged_schema(spark).fields, StructField(BATCH, LongType())])
    rows = read_parquet_guarded(spark, deltas, schema)
    if rows.isEmpty():
        return
    columns = [c for c in rows.columns if c != BATCH]
    newest = rows.groupBy(GOLD_KEY).agg(F.max_by(F.struct(*columns), BATCH).alias("r")).select("r.*")
    merge_target(materialize(newest, "gold-newest"), target_root, GOLD_KEY, merge_into_target, GOLD_TARGET)
    spark.createDataFrame([], schema).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy(BATCH).parquet(deltas)


def gold_staged_schema(spark: SparkSession) -> StructType:
    """Schema of :func:`gold_staged`, derived from the transform itself."""
    empty = spark.createDataFrame([], "ticket_id string, product_id string, urgency_score double, sentiment string")
    return gold_staged(empty).schema


def export_jdbc(
    spark: SparkSession,
    target_root: str,
    url: str,
    table: str,
    num_partitions: int = 4,
    **jdbc_kwargs,
) -> str:
    """Publish the gold target to a serving database table.

    The whole target replaces the table's rows (``truncate`` keeps
    the table and its grants). The table is emptied first and then filled
    partition by partition, not in one transaction: readers can see it empty
    or half filled, and after a failure it stays so until a retry succeeds. Text keys are
    checked against their VARCHAR bound first, and at most
    ``num_partitions`` connections write concurrently.
    """
    write_jdbc(
        read_target(spark, target_root).select(*[f.name for f in GOLD_TARGET.fields]),
        url,
        table,
        mode="overwrite",
        truncate=True,
        column_types=", ".join(f"{k} VARCHAR({n})" for k, n in GOLD_MAX_LENGTH.items()),
        max_length=GOLD_MAX_LENGTH,
        num_partitions=num_partitions,
        **jdbc_kwargs,
    )
    return target_root
