"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the exponential key ``-ln(u) / quality weight`` with a
``u`` that depends on its id only, so reruns agree. Within its source the
documents are ordered by that key; a source first gives ``floor(target/size)``
complete epochs and then the documents at the front of the order whose
prefix sum of words fits what is left of the target. One more document per
source, the one whose size comes nearest to the remaining gap, closes it.

Scale: no source is ever sorted whole. A histogram of key ranges per source
(combined map-side) tells which ranges are taken completely; only the single
range that holds the budget boundary, about 1/4096 of a source, is sorted.
Texts are read once to count words and are not shuffled by the planning.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; a null id has a key of its own; repeated rows (same id, source
and size) are taken alike; an empty table gives an empty plan; other columns
are ignored by :func:`mix_plan` and kept by :func:`apply_mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, id_bits, materialize, word_count

SOURCE_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
KEY_RANGES = 4096
BROADCAST_SOURCES = 100_000
# Rows of a plan up to which it is broadcast (about 100 bytes each), so that
# the texts are not shuffled; beyond that, the join is.
BROADCAST_PLAN = 500_000
# Weight of a document by its quality label; the smallest must be 1, which
# keeps the key ranges evenly filled.
LABEL_WEIGHTS = {1: 4, 0: 1}
UNLABELLED_WEIGHT = 2


def label_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, quality_weight) from a table of quality labels, one row per id."""
    best = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"))
    weight = F.lit(UNLABELLED_WEIGHT)
    for value, w in LABEL_WEIGHTS.items():
        weight = F.when(F.col("q") == value, w).otherwise(weight)
    return best.select("doc_id", weight.alias("quality_weight"))


def sampling_key(doc_id: str, weight: str, seed: str) -> Column:
    """-ln(u)/w with u in (0, 1) from 52 bits of a hash of the id."""
    u = (id_bits(doc_id, seed, 13) + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / F.col(weight)


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size): shares by weight, stopped at
    ``max_epochs`` times the source's size, the excess reshared by weight.

    Sources sorted by cap per weight are capped from the front; the first one
    whose share under the remaining level fits fixes that level for the rest.
    One row per source, so the global windows see a small table.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (
        s.withColumn("left", F.sum("source_size").over(everything) - F.sum("cap").over(ahead) + F.col("cap"))
        .withColumn("open_weight", F.sum("weight").over(rest))
        .withColumn("fits", F.col("left") * F.col("weight") <= F.col("cap") * F.col("open_weight"))
    )
    level = F.first(F.when(F.col("fits"), F.col("left") / F.col("open_weight")), ignorenulls=True).over(everything)
    capped = F.max(F.col("fits")).over(ahead) == F.lit(False)
    return s.withColumn("level", level).select(
        "source", "source_size",
        F.when(capped, F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"),
    )


def mix_plan(
    docs: DataFrame,
    quality: DataFrame | None = None,
    seed: str = "mix",
    weights=SOURCE_WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies), one row per
    distinct (doc_id, source, size); ``rows`` counts its repeated rows and
    ``copies`` says how often the mix takes each of them."""
    units = docs.select("doc_id", "source", word_count("text").alias("size")) \
        .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    if quality is not None:
        units = units.join(quality.select("doc_id", "quality_weight"), "doc_id", "left")
    else:
        units = units.withColumn("quality_weight", F.lit(None).cast("int"))
    units = (
        units.withColumn("quality_weight", F.coalesce("quality_weight", F.lit(UNLABELLED_WEIGHT)))
        .withColumn("key", sampling_key("doc_id", "quality_weight", seed))
        # exp(-key) is the classical u^(1/w): spread over (0, 1), so equal
        # ranges of it hold at most a few 1/KEY_RANGES of a source.
        .withColumn("range", F.least(F.floor((1 - F.exp(-F.col("key"))) * KEY_RANGES), F.lit(KEY_RANGES - 1)))
        .withColumn("words", F.col("size") * F.col("rows"))
    )
    units = materialize(units, "mix-units")

    per_range = units.groupBy("source", "range").agg(F.sum("words").alias("words"))
    per_range = materialize(per_range, "mix-ranges")
    sizes = per_range.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    targets = (
        targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    targets = materialize(targets, "mix-targets")

    # The first range that does not fit whole, and the words before it.
    up_to = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = _with_source(per_range.withColumn("upto", F.sum("words").over(up_to)), targets)
    boundary = (
        ranges.filter(F.col("upto") > F.col("rest")).groupBy("source")
        .agg(F.min(F.struct("range", (F.col("upto") - F.col("words")).alias("before"))).alias("b"))
        .select("source", F.col("b.range").alias("edge"), F.col("b.before").alias("before"))
    )
    targets = _with_source(targets, boundary, "left")

    planned = _with_source(units, _small(targets))
    edge = planned.filter(F.col("range") == F.col("edge"))
    order = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first(), "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("take", F.col("before") + F.sum("words").over(order) <= F.col("rest"))
    whole = planned.filter((F.col("range") == F.col("edge")).eqNullSafe(F.lit(True)) == F.lit(False)) \
        .withColumn("take", F.col("edge").isNull() | (F.col("range") < F.col("edge")))
    picked = materialize(whole.unionByName(edge), "mix-picked")

    # The document whose size comes nearest to the gap that is still open.
    gaps = picked.groupBy("source").agg(
        (F.first("rest") - F.sum(F.when(F.col("take"), F.col("words")).otherwise(0))).alias("gap"))
    gaps = materialize(gaps, "mix-gaps")
    left = _with_source(picked.filter(~F.col("take")), _small(gaps)) \
        .withColumn("off", F.abs(F.col("gap") - F.col("words")))
    filler = (
        left.filter(F.col("off") < F.col("gap")).groupBy("source")
        .agg(F.min(F.struct("off", "key", "doc_id", "size")).alias("f"))
        .select("source", F.col("f.doc_id").alias("f_id"), F.col("f.size").alias("f_size"))
    )
    picked = _with_source(picked, _small(materialize(filler, "mix-fillers")), "left")
    fills = F.col("f_size").isNotNull() & F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("size") == F.col("f_size"))
    taken = F.col("epochs") + (F.col("take") | fills).cast("long")
    return picked.select("doc_id", "source", "size", "rows", "source_size", "target", taken.alias("copies"))


def _small(sources: DataFrame) -> DataFrame:
    """Mark a table of one row per source for broadcasting if it is small, so
    that the rows of a large source are not dealt to one task; with more
    sources than that the join is left to the optimizer."""
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def _with_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join two tables on source, null being a source too."""
    r = right.withColumnRenamed("source", "source_r")
    common = [c for c in right.columns if c != "source" and c in left.columns]
    r = r.drop(*common)
    return left.join(r, F.col("source").eqNullSafe(F.col("source_r")), how).drop("source_r")


def apply_mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mixed corpus: every document row repeated as often as the plan says,
    with the columns of ``docs``."""
    doc_id, source, size, copies, copy = (free_name(docs, n) for n in
                                          ("mix_doc_id", "mix_source", "mix_size", "mix_copies", "mix_copy"))
    p = plan.filter(F.col("copies") > 0).select(
        F.col("doc_id").alias(doc_id), F.col("source").alias(source), F.col("size").alias(size),
        F.col("copies").cast("int").alias(copies))
    p = F.broadcast(p) if plan.count() <= BROADCAST_PLAN else p
    joined = docs.join(
        p,
        F.col("doc_id").eqNullSafe(F.col(doc_id)) & F.col("source").eqNullSafe(F.col(source))
        & (word_count("text") == F.col(size)),
    )
    repeated = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
