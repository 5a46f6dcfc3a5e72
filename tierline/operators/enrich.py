"""Enrichment of a fact stream (or table) with a static dimension.

A left outer equi-join on shared key columns: unmatched and null keys are kept
with null dimension columns, the key appears once and first (USING form).

The dimension key is cast to the type of the fact key (unparsable values
match nothing), so a text id meets a numeric one without failing.

Physical strategy:

* ``broadcast_max_rows`` set: rows and payload bytes of the dimension are
  summed in one job (partial sums per task; with ``validate_unique`` the same
  job checks the key). Within both bounds (``broadcast_max_bytes``, 256 MiB by
  default) it is broadcast, so the fact side is never shuffled. A stream only
  gets a broadcast of a snapshot, because a dimension that is read again in
  every micro-batch could outgrow the bound. Beyond them the next strategy
  applies.
* otherwise a shuffled join. Rows with a null key match nothing; they are
  spread over the tasks by a hash of the row instead of meeting in one.
* ``salt_buckets`` > 1 also spreads hot keys, by the same hash. ``hot_keys``
  names them (a frame of key values); for a table they are measured if not
  given, and only their dimension rows are replicated. A stream without
  ``hot_keys`` is salted on every key, which replicates the whole dimension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SALT = "__salt"
HOT = "__hot"

# Bytes counted per value of a fixed-width column (a generous upper bound).
FIXED_WIDTH_BYTES = 16


def _row_bytes(dim: DataFrame):
    """Payload bytes of one row: text and binary by length, the rest fixed."""
    total = F.lit(0).cast("long")
    for field in dim.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            size = F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif kind in ("array", "map", "struct", "variant"):
            size = F.coalesce(F.length(F.to_json(F.col(field.name))), F.lit(0))
        else:
            size = F.lit(FIXED_WIDTH_BYTES)
        total = total + size.cast("long")
    return total


def dimension_profile(dim: DataFrame, keys: list[str]) -> tuple[int, int, int]:
    """``(rows, largest number of rows sharing one key, payload bytes)`` in one
    job, partially aggregated per task before the shuffle."""
    row = (
        dim.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(dim)).alias("b"))
        .agg(F.sum("n").alias("rows"), F.max("n").alias("widest"), F.sum("b").alias("bytes"))
        .collect()[0]
    )
    return int(row["rows"] or 0), int(row["widest"] or 0), int(row["bytes"] or 0)


def fits_broadcast(dim: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether ``dim`` is within both bounds; every task sends one partial sum."""
    row = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(dim)).alias("b")).collect()[0]
    return int(row["n"]) <= max_rows and int(row["b"] or 0) <= max_bytes


def measured_hot_keys(facts: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: at most 1 / share rows."""
    total = facts.count()
    return facts.filter(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(HOT)) \
        .filter(F.col(HOT) > F.lit(share * total)).select(*keys)


def _any_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _salted_left_join(
    facts: DataFrame, dim: DataFrame, keys: list[str], buckets: int, hot: DataFrame | None, all_keys: bool
) -> DataFrame:
    """A shuffled left join on (keys, salt). The salt of a row comes from a
    hash of its values, so a retried task routes it alike."""
    columns = facts.columns
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(buckets)).cast("int")
    copies = F.lit(buckets - 1) if all_keys else F.lit(0)
    salted = F.lit(True) if all_keys else _any_null(keys)
    if hot is not None:
        mark = F.broadcast(hot.distinct().withColumn(HOT, F.lit(True)))  # at most 1 / share keys
        facts, dim = facts.join(mark, keys, "left"), dim.join(mark, keys, "left")
        salted = salted | F.coalesce(F.col(HOT), F.lit(False))
        copies = F.when(F.col(HOT), F.lit(buckets - 1)).otherwise(F.lit(0))
    left = facts.withColumn(SALT, F.when(salted, spread).otherwise(F.lit(0)))
    right = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), copies)))
    if hot is not None:
        left, right = left.drop(HOT), right.drop(HOT)
    return left.join(right, on=[*keys, SALT], how="left").drop(SALT)


def left_enrich(
    facts: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    *,
    broadcast_max_rows: int | None = None,
    broadcast_max_bytes: int = 256 * 1024 * 1024,
    validate_unique: bool = False,
    salt_buckets: int | None = None,
    hot_keys: DataFrame | None = None,
    hot_share: float = 0.01,
    snapshot: bool = False,
) -> DataFrame:
    """Left join ``facts`` with ``dim`` on the shared column(s) ``on``.

    ``validate_unique`` refuses a dimension with repeated keys (they would
    multiply fact rows). ``snapshot`` materializes the dimension once in the
    session's checkpoint folder, so a stream sees
    one version of it instead of re-reading the source in every micro-batch;
    a stream with a broadcast bound always takes one.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for k in keys:
        if dim.schema[k].dataType != facts.schema[k].dataType:
            dim = dim.withColumn(k, F.col(k).try_cast(facts.schema[k].dataType))
    if snapshot or facts.isStreaming and broadcast_max_rows is not None:
        dim = materialize(dim, "dimension")
    fits = False
    if validate_unique:
        rows, widest, size = dimension_profile(dim.filter(~_any_null(keys)), keys)
        if widest > 1:
            raise ValueError(f"dimension key {keys} is not unique ({widest} rows share one key)")
        fits = (broadcast_max_rows is not None and rows <= broadcast_max_rows
                and size <= broadcast_max_bytes)
    elif broadcast_max_rows is not None:
        fits = fits_broadcast(dim, broadcast_max_rows, broadcast_max_bytes)
    if fits:
        return facts.join(F.broadcast(dim), on=keys, how="left")
    if salt_buckets and salt_buckets > 1:
        hot = hot_keys
        if hot is None and not facts.isStreaming:
            hot = measured_hot_keys(facts, keys, hot_share)
        return _salted_left_join(facts, dim, keys, salt_buckets, hot, all_keys=hot is None)
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _salted_left_join(facts, dim, keys, partitions, None, all_keys=False)
