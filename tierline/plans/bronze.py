"""Landing -> bronze: stamp arrival time, append to parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.columns import stamp
from ..schemas import CORRUPT, TICKET
from ..sources.files import landing_json_stream
from ..streaming.runner import AVAILABLE_NOW, BATCH_FILES, drain, start_append

BRONZE_STAMP = "ingested_at"


def bronze_frame(raw: DataFrame) -> DataFrame:
    """Landing rows plus their arrival time."""
    return stamp(raw, BRONZE_STAMP)


def run_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    trigger: dict | None = AVAILABLE_NOW,
    schema: StructType = TICKET,
    max_files_per_trigger: int | None = BATCH_FILES,
    source_options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
    keep_corrupt: bool = True,
) -> StreamingQuery:
    """Start the landing -> bronze stream. With the default ``availableNow``
    trigger it returns once every landed file is in bronze; with another
    trigger the running query is returned to the caller.

    ``keep_corrupt`` keeps the text of an unparsable landing file in the
    ``_corrupt_record`` column of its (otherwise all-null) bronze row, so the
    silver step can reject it with that reason and the evidence."""
    if keep_corrupt and CORRUPT not in schema.fieldNames():
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    raw = landing_json_stream(spark, landing, schema, max_files_per_trigger, source_options,
                              corrupt_column=CORRUPT if keep_corrupt else None)
    query = start_append(bronze_frame(raw), bronze, checkpoint, trigger, partition_by=partition_by)
    if trigger and trigger.get("availableNow"):
        drain(query)
    return query
