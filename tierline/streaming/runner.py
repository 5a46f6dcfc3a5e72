"""Starting and draining append-only streaming queries.

Every query has its own checkpoint folder; the file sink's commit log makes
the output exactly once, so a rerun or restart with the same checkpoint
adds only files it has not processed. Failures are raised, never swallowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Trigger keyword sets for DataStreamWriter.trigger.
AVAILABLE_NOW = {"availableNow": True}

# Default file limit per micro-batch of the tier streams: a large backlog is
# drained in bounded batches instead of one giant one (results do not depend
# on the limit; see the rate-limit invariance check).
BATCH_FILES = 1000


def processing_time(interval: str) -> dict:
    return {"processingTime": interval}


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start appending ``stream`` to files at ``path``; ``trigger=None`` is
    Spark's default (next micro-batch as soon as the last one ends)."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start(path)


def drain(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait until ``query`` ends; raise its failure if it failed."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        finished = query.awaitTermination(timeout_s)
        if not finished:
            query.stop()
            raise TimeoutError(f"streaming query did not finish within {timeout_s}s")
    failure = query.exception()
    if failure is not None:
        raise failure
    return query


class Streams:
    """A main query and the queries that belong to it (its rejects): drained,
    stopped and failing together. Other attributes are the main query's."""

    def __init__(self, main: StreamingQuery):
        self.queries = [main]

    def add(self, start) -> None:
        """Start another query; if that fails, the others are stopped."""
        try:
            self.queries.append(start())
        except Exception:
            self.stop()
            raise

    def drain(self, timeout_s: float | None = None) -> "Streams":
        try:
            for query in self.queries:
                drain(query, timeout_s)
        except Exception:
            self.stop()
            raise
        return self

    def processAllAvailable(self) -> None:
        for query in self.queries:
            query.processAllAvailable()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()

    def exception(self):
        return next((e for q in self.queries if (e := q.exception()) is not None), None)

    def __getattr__(self, name: str):
        return getattr(self.queries[0], name)


def run_available_now(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Process everything available now (respecting the source's rate limit
    in as many micro-batches as needed), then stop."""
    query = start_append(stream, path, checkpoint, AVAILABLE_NOW, fmt, partition_by)
    return drain(query)


def batches_with_input(query: StreamingQuery) -> int:
    """Number of finished micro-batches that read at least one row, among the
    recent progress updates Spark keeps (the last 100 by default)."""
    return sum(1 for p in query.recentProgress if p.get("numInputRows", 0) > 0)


def batch_count(query: StreamingQuery) -> int:
    """Micro-batches run on the query's checkpoint so far (ids start at 0)."""
    last = query.lastProgress
    return 0 if not last else int(last["batchId"]) + 1
