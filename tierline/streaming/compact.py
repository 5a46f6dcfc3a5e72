"""Few large files from many small ones, for the tables that streams append to.

A stream writes at least a file per micro-batch and task, so a tier that is fed
by small landings ends in thousands of files. The file sink's log names every
one of them, so they cannot be merged in place. Compaction is therefore a
stream of its own over the tier: a micro-batch takes files up to a number of
bytes and writes them as files of about ``target_bytes`` into one folder
``batch=<id>``. The checkpoint holds which files are done, a replayed
micro-batch overwrites its folder: no row is lost or there twice. Readers of
the small files and of the compacted ones are not disturbed; downstream streams
read the compacted table.

Rows are not shuffled: small files are read together by as many tasks as files
are to be written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import file_stream
from .runner import AVAILABLE_NOW, drain

TARGET_BYTES = 128 * 1024 * 1024
BATCH = "batch"
# Files that a micro-batch writes at most.
FILES_PER_BATCH = 1_000


def run_compaction(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    schema: StructType,
    target_bytes: int = TARGET_BYTES,
    files_per_batch: int = FILES_PER_BATCH,
    trigger: dict | None = AVAILABLE_NOW,
    max_file_age: str | None = None,
) -> StreamingQuery | None:
    """Append the parquet table ``source`` to ``out`` (partition column
    ``batch``) in files of about ``target_bytes``. With the default trigger it
    returns when everything there is compacted; run it as often as it pays,
    since what is new since the last run makes at least one file. A source that
    does not exist yet is nothing to do (returns None)."""
    reader = file_stream(spark).schema(schema).option("maxBytesPerTrigger", int(target_bytes) * int(files_per_batch))
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    try:
        rows = reader.parquet(source)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    sized = rows.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_size").alias("__size"))

    def write(batch: DataFrame, batch_id: int) -> None:
        held = int(batch.select("__path", "__size").distinct().agg(F.sum("__size")).first()[0] or 0)
        files = max(1, round(held / target_bytes))
        batch.drop("__path", "__size").coalesce(files).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    writer = sized.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = (writer.trigger(**trigger) if trigger else writer).start()
    return drain(query) if trigger and trigger.get("availableNow") else query
