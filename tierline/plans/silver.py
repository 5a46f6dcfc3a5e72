"""Bronze -> silver, for events (enrichment) and for tickets (triage)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.triage import DEFAULT_OUTCOME, DEFAULT_RULES, Outcome, Rule, with_triage
from ..operators.columns import parse_timestamp, stamp
from ..operators.enrich import left_enrich
from ..operators.keys import REASON, key_rejects, require_key
from ..schemas import CORRUPT, RAW_EVENT, TICKET
from ..session import file_stream
from ..sources.files import event_json_stream
from ..streaming.enrich import enrich_each_batch
from ..streaming.runner import AVAILABLE_NOW, BATCH_FILES, Streams, drain, start_append
from .bronze import BRONZE_STAMP

BRONZE_TICKET = StructType(
    TICKET.fields
    + [StructField(CORRUPT, StringType(), True), StructField(BRONZE_STAMP, TimestampType(), True)]
)
UNPARSABLE = "unparsable landing file"
UNPARSABLE_EVENT = "unparsable event line"


def silver_events(
    raw: DataFrame,
    dim: DataFrame,
    key: str = "user_id",
    event_key: str = "event_id",
    **join_options,
) -> DataFrame:
    """Require the event key, left-join the dimension on ``key``, stamp the
    processing time and parse the event time (the raw text is dropped).

    Output order: key, remaining event columns, dimension columns,
    ingestion_timestamp, event_timestamp.
    """
    kept = require_key(raw, event_key).drop(CORRUPT)
    return _timed(left_enrich(kept, dim, key, **join_options))


def _timed(joined: DataFrame) -> DataFrame:
    return parse_timestamp(stamp(joined, "ingestion_timestamp"), "timestamp", "event_timestamp")


def _start_silver(raw: DataFrame, dim, out: str, checkpoint: str, trigger: dict | None, key: str = "user_id",
                  event_key: str = "event_id", **join_options) -> StreamingQuery:
    if not callable(dim):
        return start_append(silver_events(raw, dim, key, event_key, **join_options), out, checkpoint, trigger)
    join_options.pop("snapshot", None)  # each micro-batch takes its own
    kept = require_key(raw, event_key).drop(CORRUPT)
    return enrich_each_batch(kept, dim, key, out, checkpoint, trigger, _timed, **join_options)


def run_silver_events(
    spark: SparkSession,
    source: str,
    dim: DataFrame | Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    max_files_per_trigger: int | None = 100,
    multi_line: bool = False,
    trigger: dict | None = AVAILABLE_NOW,
    rejects: str | None = None,
    rejects_checkpoint: str | None = None,
    keep_corrupt: bool = True,
    **join_options,
) -> Streams:
    """Raw event JSON files -> silver parquet, drained with ``availableNow``.

    A ``dim`` that is a function is called in every micro-batch, which then
    measures, checks and joins the version it gets; silver is partitioned by
    ``batch`` in that case (see :mod:`tierline.streaming.enrich`).

    With ``rejects`` the rows without an event id, and the lines that do not
    parse, are appended there too (with a reason and the text). The lines are
    then parsed once, by a first stream that lands every row as parquet under
    ``{checkpoint}-landed``; silver and rejects are streams over that, so both
    are exactly once and rows in = silver rows + rejects. The queries returned
    are drained, stopped and fail together.
    """
    schema = RAW_EVENT
    if keep_corrupt:
        schema = StructType(RAW_EVENT.fields + [StructField(CORRUPT, StringType(), True)])
    raw = event_json_stream(spark, source, schema, max_files_per_trigger, multi_line,
                            corrupt_column=CORRUPT if keep_corrupt else None)
    drains = bool(trigger and trigger.get("availableNow"))
    if not rejects:
        streams = Streams(_start_silver(raw, dim, out, checkpoint, trigger, **join_options))
        return streams.drain() if drains else streams
    root = checkpoint.rstrip("/")
    landed = f"{root}-landed"
    landing = start_append(raw, landed, f"{root}-landing", trigger)
    if drains:
        drain(landing)
    rows = file_stream(spark).schema(schema).option("maxFilesPerTrigger", BATCH_FILES).parquet(landed)
    streams = Streams(landing)
    streams.add(lambda: _start_silver(rows, dim, out, checkpoint, trigger, **join_options))
    streams.add(lambda: start_append(_rejected(rows, "event_id", UNPARSABLE_EVENT), rejects,
                                     rejects_checkpoint or f"{root}-rejects", trigger))
    return streams.drain() if drains else streams


def _rejected(raw: DataFrame, key: str, unparsable: str) -> DataFrame:
    rejects = key_rejects(raw, key)
    if CORRUPT in raw.columns:
        rejects = rejects.withColumn(
            REASON, F.when(F.col(CORRUPT).isNotNull(), F.lit(unparsable)).otherwise(F.col(REASON))
        )
    return rejects


def silver_tickets(
    bronze: DataFrame,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: Outcome = DEFAULT_OUTCOME,
) -> DataFrame:
    """Keyed tickets with their triage (sentiment, urgency_score, summary),
    the parsed ticket time and the processing time."""
    kept = require_key(bronze, "ticket_id").drop(CORRUPT)
    triaged = with_triage(kept, "review_text", "triage", rules, default, flatten=True)
    parsed = parse_timestamp(triaged, "timestamp", "ticket_timestamp")
    return stamp(parsed, "processed_at")


def run_silver_tickets(
    spark: SparkSession,
    bronze: str,
    out: str,
    checkpoint: str,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: Outcome = DEFAULT_OUTCOME,
    max_files_per_trigger: int | None = BATCH_FILES,
    trigger: dict | None = AVAILABLE_NOW,
    rejects: str | None = None,
    rejects_checkpoint: str | None = None,
) -> Streams:
    """Bronze parquet (as a stream) -> triaged silver parquet; unkeyed bronze
    rows (e.g. from unparsable landing files) optionally go to ``rejects``."""
    reader = file_stream(spark).schema(BRONZE_TICKET)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    bronze_rows = reader.parquet(bronze)
    streams = Streams(start_append(silver_tickets(bronze_rows, rules, default), out, checkpoint, trigger))
    if rejects:
        streams.add(lambda: start_append(_rejected(bronze_rows, "ticket_id", UNPARSABLE), rejects,
                                         rejects_checkpoint or f"{checkpoint}-rejects", trigger))
    return streams.drain() if trigger and trigger.get("availableNow") else streams


def gold_input(silver: DataFrame) -> DataFrame:
    """Columns the gold aggregation reads, urgency as double."""
    return silver.select(
        "ticket_id",
        "product_id",
        F.col("urgency_score").cast("double").alias("urgency_score"),
        "sentiment",
    )
