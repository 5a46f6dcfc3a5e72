"""Enrichment of a stream with a dimension that changes while it runs.

The dimension is read again in every micro-batch. There it is materialized, so
that what is measured is what is joined; its key is checked for repeats, it is
measured, and the join is chosen anew (:func:`tierline.operators.enrich.left_enrich`):
a dimension that outgrows the broadcast bound falls back to a shuffled join with
the next micro-batch, not with the next restart. Every row is joined with the
version of its own micro-batch.

Hot keys. With ``salt_buckets`` the keys that hold many rows are spread over
the tasks. Which keys these are is learnt from the stream: a frequent-items
sketch of bounded size is carried from micro-batch to micro-batch, so a key is
known by its share of all rows so far, and only the dimension rows of such keys
are replicated.

Output is one folder ``batch=<id>`` per micro-batch, written whole; a replayed
micro-batch overwrites its folder, so every row is there once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import left_enrich, measured_hot_keys
from ..session import materialize
from ..sources.files import read_parquet_guarded
from .runner import AVAILABLE_NOW, drain

BATCH = "batch"
SLOT = "slot"
# Items that the sketch tracks per hot key that there can be.
TRACKED_PER_KEY = 16


class HotKeys:
    """The keys that hold more than ``share`` of all rows seen, from a sketch
    kept under ``path``.

    Two slots are written in turn, the older one being overwritten, so a
    replayed micro-batch finds the state before it and the folder stays small.
    The sketch may name a key that is a little below the share; it misses none
    above it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, share: float):
        self.spark, self.path, self.key, self.share = spark, path, key, share
        self.keys = math.ceil(1 / share)
        self.tracked = self.keys * TRACKED_PER_KEY

    def _state(self, batch_id: int) -> DataFrame | None:
        """The state after the newest micro-batch before ``batch_id``."""
        empty = self._sketch(self.spark.createDataFrame([], "k string")).withColumn(SLOT, F.lit(0))
        states = read_parquet_guarded(self.spark, self.path, empty.schema).filter(F.col(BATCH) < batch_id)
        newest = states.agg(F.max(BATCH)).first()[0]
        return None if newest is None else states.filter(F.col(BATCH) == newest).drop(SLOT)

    def _sketch(self, keys: DataFrame) -> DataFrame:
        return keys.agg(F.expr(f"approx_top_k_accumulate(k, {self.tracked})").alias("sketch"),
                        F.count(F.lit(1)).alias("rows")).withColumn(BATCH, F.lit(0).cast("long"))

    def update(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Add a micro-batch; returns the hot keys so far (at most 1 / share),
        as a frame of the key's type."""
        keys = batch.select(F.col(self.key).cast("string").alias("k")).filter("k is not null")
        state, before = self._sketch(keys), self._state(batch_id)
        if before is not None:
            # Two rows, in one partition: combining fails on a partition without rows.
            state = before.unionByName(state).coalesce(1).agg(
                F.expr(f"approx_top_k_combine(sketch, {self.tracked})").alias("sketch"), F.sum("rows").alias("rows"))
        # One row of bounded size, computed before the slot that it may have come from is overwritten.
        state = state.select("sketch", "rows", F.lit(batch_id).cast("long").alias(BATCH))
        state = self.spark.createDataFrame(state.collect(), state.schema)
        slot = f"{self.path}/{SLOT}={batch_id % 2}"
        state.write.mode("overwrite").parquet(slot)
        found = self.spark.read.parquet(slot).select(
            "rows", F.expr(f"inline(approx_top_k_estimate(sketch, {self.keys}))"))
        hot = found.filter((F.col("item").isNotNull()) & (F.col("count") > self.share * F.col("rows"))).select("item").collect()
        kind = batch.schema[self.key].dataType
        names = self.spark.createDataFrame([(r["item"],) for r in hot], "k string")  # at most 1 / share rows
        return names.select(F.col("k").cast(kind).alias(self.key))


def enrich_each_batch(
    stream: DataFrame,
    dimension: Callable[[], DataFrame],
    on: str | list[str],
    out: str,
    checkpoint: str,
    trigger: dict | None = AVAILABLE_NOW,
    then: Callable[[DataFrame], DataFrame] | None = None,
    validate_unique: bool = True,
    salt_buckets: int | None = None,
    hot_share: float = 0.01,
    **join_options,
) -> StreamingQuery:
    """Start the left enrichment of ``stream`` with what ``dimension()`` reads
    in each micro-batch, appended below ``out`` (partition column ``batch``).

    ``then`` is applied to the joined rows (stamps, parsing). With one key
    column hot keys come from the sketch, with several they are measured in
    every micro-batch. A dimension with repeated keys fails its micro-batch,
    which runs again after a restart. The default trigger drains and stops.
    """
    spark = stream.sparkSession
    keys = [on] if isinstance(on, str) else list(on)
    sketch = HotKeys(spark, f"{checkpoint.rstrip('/')}-hot-keys", keys[0], hot_share) if len(keys) == 1 else None

    def join(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read by the sketch and by the join; lost parts are computed again
        try:
            hot = None
            if salt_buckets:
                hot = sketch.update(batch, batch_id) if sketch else measured_hot_keys(batch, keys, hot_share)
            joined = left_enrich(batch, materialize(dimension(), "dimension"), keys, validate_unique=validate_unique,
                                 salt_buckets=salt_buckets, hot_keys=hot, **join_options)
            (then(joined) if then else joined).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(join).option("checkpointLocation", checkpoint)
    query = (writer.trigger(**trigger) if trigger else writer).start()
    return drain(query) if trigger and trigger.get("availableNow") else query
