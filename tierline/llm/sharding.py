"""Sharding by extendible hashing (DataFrame functions only).

A directory indexed by hash-prefix bits: the corpus starts as one bucket, and
only a bucket whose bytes exceed the limit is split on the next bit of the
hash, until every shard fits. The tree is not grown by passes over the data:
a histogram over the next 12 bits of all oversized buckets gives the sums of
all their descendants, so a corpus needs one round per 12 bits of depth.

Defined results: a null text has 0 bytes; a null id hashes like ''; repeated
ids share a hash and so a shard; a shard that 60 bits cannot split (one
document above the limit, or copies of one id) stays as it is and is marked
``oversized``; an empty table gives no shards; all columns are kept in the
files, and where the input has a column ``shard``, the new one gets another name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_bits, materialize

LIMIT_BYTES = 64 * 1024 * 1024
HASH_BITS = 60
ROUND_BITS = 12
SEED = "shard"


def _hash_bits() -> Column:
    """The 60 hash bits of a document as a string of 0 and 1."""
    return F.lpad(F.bin(id_bits("doc_id", SEED, HASH_BITS // 4)), HASH_BITS, "0")


def build_directory(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> list[DataFrame]:
    """The directory, one table per round: (cell, shard). ``cell`` is a hash
    prefix of 12, 24, ... bits; ``shard`` is its leaf ('s' and the prefix bits
    of the leaf), or null where the leaf lies deeper, in the next table."""
    base = docs.select(_hash_bits().alias("bits"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    base = materialize(base, "shard-hashes")
    levels: list[DataFrame] = []
    above = None  # cells that are still too large
    for end in range(ROUND_BITS, HASH_BITS + 1, ROUND_BITS):
        start = end - ROUND_BITS
        rows = base.withColumn("root", F.substring("bits", 1, start))
        if above is not None:
            rows = rows.join(above, "root", "left_semi")
        cells = rows.groupBy("root", F.substring("bits", 1, end).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"))
        cells = materialize(cells, f"shard-cells-{end}")
        # The sums of every descendant of a root, down to the cells.
        depths = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("depth")
        sums = (
            cells.select("cell", "n_bytes", depths)
            .groupBy(F.substring("cell", F.lit(1), F.col("depth")).alias("prefix"), "depth")
            .agg(F.sum("n_bytes").alias("n_bytes"))
        )
        fits = sums.filter((F.col("n_bytes") <= limit_bytes) | (F.col("depth") == HASH_BITS))
        # A cell's leaf is its shortest prefix that fits.
        leaf = (
            cells.select("cell", depths).withColumn("prefix", F.substring("cell", F.lit(1), F.col("depth")))
            .join(fits.select("prefix", "depth"), ["prefix", "depth"], "left_semi")
            .groupBy("cell").agg(F.min(F.struct("depth", "prefix")).alias("leaf"))
            .select("cell", F.concat(F.lit("s"), F.col("leaf.prefix")).alias("shard"))
        )
        level = materialize(cells.select("cell").join(leaf, "cell", "left"), f"shard-directory-{end}")
        levels.append(level)
        above = level.filter(F.col("shard").isNull()).select(F.col("cell").alias("root"))
        if above.isEmpty():
            break
    return levels


def assign_shards(docs: DataFrame, directory: list[DataFrame]) -> DataFrame:
    """``docs`` with the column ``shard`` last, looked up by hash prefix (with
    underscores added to the name if ``docs`` has such a column)."""
    bits, shard = free_name(docs, "shard_bits"), free_name(docs, "shard")
    out = docs.withColumn(bits, _hash_bits())
    found = []
    for i, level in enumerate(directory):
        cell, leaf = free_name(docs, f"shard_cell_{i}"), free_name(docs, f"shard_leaf_{i}")
        cells = level.select(F.col("cell").alias(cell), F.col("shard").alias(leaf))
        out = out.join(cells, F.substring(bits, 1, (i + 1) * ROUND_BITS) == F.col(cell), "left")
        found.append(F.col(leaf))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns],
                      reduce(lambda a, b: F.coalesce(a, b), found).alias(shard))


def write_shards(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES) -> None:
    """Write ``docs`` as one folder of Parquet files per shard under ``path``.

    The number of write tasks follows the number of shards, so a task holds a
    few shards of bounded size however large the corpus is. A shard that the
    hash cannot split (rows of one id) is written by as many tasks, each a file
    of its folder.
    """
    directory = build_directory(docs, limit_bytes)
    n_shards = sum(level.filter(F.col("shard").isNotNull()).select("shard").distinct().count() for level in directory)
    sharded = assign_shards(docs, directory)
    shard = sharded.columns[-1]
    tasks = max(2, 2 * n_shards)
    unsplit = F.length(shard) > HASH_BITS
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), "text"), F.lit(tasks))
    dealt = sharded.repartition(tasks, F.col(shard), F.when(unsplit, spread).otherwise(F.lit(0)))
    dealt.write.partitionBy(shard).parquet(path)
