"""Near-duplicate groups: MinHash bands, sequential Bayesian verification,
exact confirmation on full shingle sets.

1. Each text becomes the set of its distinct word shingles (64-bit hashes), a
   digest of the whole set and a MinHash signature. Texts with the same set
   form a class; the class member with the smallest doc_id stands for it, so
   thousands of copies cost one row from here on.
2. Signatures are cut into bands of 5; documents that agree on a band are
   candidates. There are so many bands that a pair at the threshold shares none
   with a probability under ``MISS_PROBABILITY``.
3. Candidate pairs are compared signature batch by batch. After each batch the
   posterior of the similarity (uniform prior, so a Beta distribution) is
   known, and a pair is pruned once the probability that it reaches the
   threshold is under ``MISS_PROBABILITY``.
4. Survivors are confirmed on their full sets, in integers. Connected
   components of the confirmed links are found by alternating star steps.

No bucket is expanded into all its pairs. Star rounds first pair each document
with one member of its buckets and merge what is confirmed, so a group of
thousands of near copies costs about one comparison per member. What shares a
band but is still in different components is then compared pair by pair, after
two exact bounds: shingles that no other candidate has cannot be shared, which
limits the similarity of any pair; so only pairs whose bound reaches the
threshold are formed, and one side of such a pair always has few own shingles.
No link between different texts is lost to a cap.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text with fewer words than a shingle has one
shingle, its whole word sequence; a row without doc_id is linked with nothing
and stays (component null); rows that repeat both doc_id and text are one
document; texts that share a doc_id are documents of their own, linked only if
they are similar, so none is dropped for what another one is; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, small_batches
from .word_hashes import mix, shingle_hashes, word_hashes

BAND_ROWS = 5
MISS_PROBABILITY = 1e-6
BATCH_HASHES = 20
# Star rounds go on while more pairs than this per banded row are left and the
# last round took away a fifth of them. It only orders the work.
PAIRS_PER_ROW = 4
STAR_ROUNDS = 6
# Ids up to which rows are picked by a broadcast (16 bytes each); beyond that,
# by a shuffled join.
BROADCAST_IDS = 4_000_000
# Candidate pairs up to which they are broadcast (16 bytes each), so that only
# the signatures and sets of these pairs move; beyond that, joins are shuffled.
BROADCAST_PAIRS = 1_000_000
# Shingles x hashes that are computed at a time (a few MB).
SLICE_CELLS = 1 << 19

MOST_BANDS = 64
# Length of the signatures for what star rounds leave open; one bit a hash,
# compared in words of 64.
LONG_HASHES = 3840
LONG_BATCHES = (512, 1280, 2560, LONG_HASHES)
# Rows of a bucket that are compared with each other in one step.
BLOCK_ROWS = 512
_rng = np.random.default_rng(20_240_501)
_XOR = _rng.integers(0, 2**32, LONG_HASHES, dtype=np.uint32)[:, None]
_ODD = _rng.integers(0, 2**31, LONG_HASHES, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_BAND_ODD = _rng.integers(0, 2**62, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SEED = _rng.integers(0, 2**63, MOST_BANDS, dtype=np.uint64)


def band_count(threshold: float) -> int:
    """The fewest bands that miss a pair at the threshold with a probability
    under ``MISS_PROBABILITY`` (24 at 0.85, 35 at 0.8)."""
    n = int(np.ceil(np.log(MISS_PROBABILITY) / np.log1p(-threshold**BAND_ROWS)))
    if n > MOST_BANDS:
        raise ValueError(f"threshold {threshold} needs {n} bands; {MOST_BANDS} are defined")
    return n


# ------------------------------------------------------------------ texts

def shingle_set(text: str | None, shingle_words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(word_hashes(text), shingle_words)) if text else np.empty(0, dtype=np.uint64)


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash values (u32) of a non-empty set."""
    low = np.full(hashes, 0xFFFFFFFF, dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    step = max(64, SLICE_CELLS // hashes)
    for at in range(0, len(short), step):
        values = short[None, at:at + step] ^ _XOR[:hashes]
        values *= _ODD[:hashes]
        np.minimum(low, values.min(axis=1), out=low)
    return low


def profiles(docs: DataFrame, shingle_words: int, hashes: int) -> DataFrame:
    """(doc_id, n_shingles, digest, signature) of every row."""
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, shingle_words)
                sizes.append(len(s))
                digests.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signatures.append(signature(s, hashes).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())], names=["doc_id", "n_shingles", "digest", "signature"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        profile, "doc_id long, n_shingles long, digest binary, signature binary")


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """The bucket keys (i64) of signatures, one column per band."""
    rows = signatures.reshape(len(signatures), -1, BAND_ROWS).astype(np.uint64)
    return mix((rows * _BAND_ODD).sum(axis=2, dtype=np.uint64) + _BAND_SEED[:rows.shape[1]]).view(np.int64)


def bands(classes: DataFrame, n_bands: int) -> DataFrame:
    """(key, node, size): one row per class and band."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint32)
            keys = band_keys(rows.reshape(-1, n_bands * BAND_ROWS)).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), n_bands)),
                 pa.array(np.repeat(batch.column(1).to_numpy(), n_bands))], names=["key", "node", "size"])

    return classes.select("node", "size", "signature").mapInArrow(cut, "key long, node long, size long")


# ------------------------------------------------------------ verification

def least_matches(threshold: float, batches: Iterable[int], miss: float = MISS_PROBABILITY) -> list[tuple[int, int]]:
    """(n, m) for each batch end n: the fewest matches m of n hashes at which
    the posterior probability of reaching the threshold is at least ``miss``.

    With a uniform prior the posterior after m of n matches is
    Beta(m + 1, n - m + 1), whose tail above t is P(Binomial(n + 1, t) <= m).
    """
    least = []
    for n in batches:
        m = np.arange(n + 2)
        ways = np.array([lgamma(n + 2) - lgamma(i + 1) - lgamma(n + 2 - i) for i in m])
        tail = np.cumsum(np.exp(ways + m * log(threshold) + (n + 1 - m) * log(1 - threshold)))
        least.append((n, int(np.argmax(tail >= miss))))
    return least


def prune(pairs: DataFrame, candidates: DataFrame, threshold: float, hashes: int) -> DataFrame:
    """The pairs (a, b) that survive the sequential comparison of signatures."""
    least = least_matches(threshold, [*range(BATCH_HASHES, hashes, BATCH_HASHES), hashes])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, hashes)
                           for c in (2, 3))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            done = 0
            for n, fewest in least:
                part, done = slice(done, n), n
                matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
                stays = matches >= fewest
                alive, matches = alive[stays], matches[stays]
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], names=["a", "b"])

    return _with_both(pairs, candidates, "signature").mapInArrow(compare, "a long, b long")


def few(ids: DataFrame) -> DataFrame:
    """``ids``, marked for broadcasting if they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(a, b, x, y): the pairs with ``column`` of both nodes."""
    small = pairs.count() <= BROADCAST_PAIRS
    left = pairs.select("a").distinct()
    x = table.join(F.broadcast(left) if small else left, F.col("node") == F.col("a"), "left_semi") \
        .select(F.col("node").alias("a"), F.col(column).alias("x"))
    y = table.select(F.col("node").alias("b"), F.col(column).alias("y"))
    return y.join(F.broadcast(pairs) if small else pairs, "b").join(x, "a").select("a", "b", "x", "y")


def confirm(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs whose full sets reach the threshold, checked in integers."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            left, right = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(2), batch.column(3)))
            for r in range(batch.num_rows):
                x, y = (values[at[r]:at[r + 1]] for at, values in (left, right))
                both = len(x) + len(y) - len(np.union1d(x, y))
                if denominator * both >= numerator * (len(x) + len(y) - both):
                    kept.append(r)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])

    return _with_both(pairs, sets, "shingles").mapInArrow(check, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """(node, shingles): the full sets of the documents ``nodes``."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle_words).view(np.int64) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node", "left_semi")
    return texts.mapInArrow(build, "node long, shingles array<long>")


# -------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is
    named by its smallest node. Alternating large-star and small-star steps;
    each step is written to the shared folder, nothing goes to the driver but
    a checksum."""
    def checksum(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "components")
    before = checksum(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a") \
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select("a", F.col("low").alias("b")) \
            .unionByName(small.filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b")))
        edges = materialize(small.distinct(), "components")
        after = checksum(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


# ------------------------------------------------------------------ groups

def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, numerator: int = 80, denominator: int = 100,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if denominator * |intersection| >= numerator * |union|
    of their shingle sets; a component is named by its smallest doc_id, which
    is the one that is kept.
    """
    nodes = _text_nodes(docs)
    if nodes is None:
        return _groups(docs, shingle_words, numerator, denominator)
    numbered = _with_node(docs, nodes, "node")
    groups = _groups(numbered.select(F.col("node").alias("doc_id"), "text"), shingle_words, numerator, denominator)
    own = nodes.select("node", "doc_id")
    named = groups.withColumnsRenamed({"doc_id": "node", "component_id": "root"}).join(own, "node", "left") \
        .join(own.select(F.col("node").alias("root"), F.col("doc_id").alias("component_id")), "root", "left")
    return named.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _text_nodes(docs: DataFrame) -> DataFrame | None:
    """(doc_id, text_key, node): a number for each text of each doc_id, in the
    order of the ids; None if every id has one text, which then stands for it."""
    keyed = docs.filter(F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    several = keyed.groupBy("doc_id").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b")).filter("a <> b")
    if several.isEmpty():
        return None
    # Numbers grow along the partitions of a sorted frame; written once, they stay.
    ordered = keyed.distinct().sort("doc_id", "text_key").withColumn("node", F.monotonically_increasing_id())
    return materialize(ordered, "dups-nodes-of-texts")


def _with_node(docs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """``docs`` with the node of each row (null without doc_id)."""
    named = nodes.select(F.col("doc_id").alias(f"{name}_id"), F.col("text_key").alias(f"{name}_key"), F.col("node").alias(name))
    same = (F.col("doc_id").cast("long") == F.col(f"{name}_id")) & (F.xxhash64("text") == F.col(f"{name}_key"))
    return docs.join(named, same, "left").drop(f"{name}_id", f"{name}_key")


def _groups(docs: DataFrame, shingle_words: int, numerator: int, denominator: int) -> DataFrame:
    """:func:`near_duplicates` where rows that repeat a doc_id repeat its text."""
    threshold = numerator / denominator
    n_bands = band_count(threshold)
    hashes = n_bands * BAND_ROWS
    small_batches(docs.sparkSession)
    rows = materialize(profiles(docs, shingle_words, hashes), "dups-profiles")
    linkable = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(
        linkable.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("c"))
        .select("digest", F.col("c.doc_id").alias("node"), F.col("c.n_shingles").alias("size"),
                F.col("c.signature").alias("signature")), "dups-classes")
    banded = bands(classes, n_bands)
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key")
    shared = materialize(banded.join(buckets, "key"), "dups-shared")
    n_shared = shared.count()
    named = None
    if n_shared:
        nodes = materialize(shared.select("node").distinct(), "dups-nodes")
        nodes = few(nodes)
        sets = materialize(shingle_sets(docs, nodes, shingle_words), "dups-sets")
        candidates = materialize(classes.select("node", "signature").join(nodes, "node", "left_semi"), "dups-candidates")

        def verify(pairs: DataFrame, name: str) -> DataFrame:
            pairs = materialize(pairs, f"dups-pairs-{name}")
            survivors = materialize(prune(pairs, candidates, threshold, hashes), f"dups-survivors-{name}")
            return materialize(confirm(survivors, sets, numerator, denominator), f"dups-links-{name}")

        links, before = None, None
        for r in range(STAR_ROUNDS):
            found = verify(_star_pairs(_tag(shared, named), r, numerator, denominator), f"star-{r}")
            links = found if links is None else links.unionByName(found)
            if not found.isEmpty():
                named = materialize(components(links), f"dups-named-{r}")
            left = _open_pairs(_tag(shared, named))
            if left <= PAIRS_PER_ROW * n_shared or before is not None and left > 0.8 * before:
                break
            before = left
        if left:
            rest = materialize(_rest_pairs(_tag(shared, named), candidates, sets, numerator, denominator), "dups-survivors-rest")
            found = materialize(confirm(rest, sets, numerator, denominator), "dups-links-rest")
            if not found.isEmpty():
                named = materialize(components(links.unionByName(found)), "dups-named")

    members = classes.select("digest", "node", F.col("node").alias("component_id"))
    if named is not None:
        members = classes.select("digest", "node").join(named, "node", "left") \
            .select("digest", F.coalesce("component", "node").alias("component_id"))
    out = rows.join(members.select("digest", "component_id"), "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, shingle_words: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """``docs`` with one document of each group; rows that repeat both doc_id
    and text count as one document and leave one row, texts that share a doc_id
    are kept or dropped each for itself. Rows without doc_id stay."""
    nodes = _text_nodes(docs)
    name = free_name(docs, "dup_node")
    numbered = docs.withColumn(name, F.col("doc_id").cast("long")) if nodes is None else _with_node(docs, nodes, name)
    rows = materialize(_groups(numbered.select(F.col(name).alias("doc_id"), "text"), shingle_words, numerator, denominator)
                       .select(F.col("doc_id").alias(name), "kept"), "dups-kept")
    dropped = few(materialize(rows.filter(~F.col("kept")).select(name).distinct(), "dups-dropped"))
    repeated = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col(name).isNotNull()).select(name)
    left = numbered.join(dropped, name, "left_anti")
    if not repeated.isEmpty():
        repeated = materialize(repeated, "dups-repeated")
        left = left.join(repeated, name, "left_anti").unionByName(
            left.join(repeated, name, "left_semi").dropDuplicates([name]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def _tag(shared: DataFrame, named: DataFrame | None) -> DataFrame:
    if named is None:
        return shared.withColumn("component", F.col("node"))
    return shared.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _similar_size(x, y, numerator: int, denominator: int):
    """Whether sets of these sizes can reach the threshold at all."""
    return F.least(x, y) * denominator >= F.greatest(x, y) * numerator


def _star_pairs(tagged: DataFrame, r: int, numerator: int, denominator: int) -> DataFrame:
    """(a, b): each node b with one centre a of its buckets that is in another
    component. Centres are the smallest nodes, in later rounds by another hash."""
    order = F.col("node") if r == 0 else F.xxhash64(F.lit(r), "node")
    centre = (
        tagged.groupBy("key")
        .agg(F.min(F.struct(order.alias("h"), "node", "size", "component")).alias("c"),
             F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter(F.col("lo") != F.col("hi"))
        .select("key", F.col("c.h").alias("h"), F.col("c.node").alias("centre"),
                F.col("c.size").alias("c_size"), F.col("c.component").alias("c_component"))
    )
    return (
        tagged.join(centre, "key")
        .filter((F.col("component") != F.col("c_component"))
                & _similar_size(F.col("size"), F.col("c_size"), numerator, denominator))
        .groupBy("node").agg(F.min(F.struct("h", "centre")).alias("c"))
        .select(F.col("c.centre").alias("a"), F.col("node").alias("b"))
    )


def _open_pairs(tagged: DataFrame) -> int:
    """How many pairs share a bucket and are in different components, at most."""
    per_key = tagged.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("key").agg(F.sum("n").alias("all"), F.max("n").alias("top"))
    return per_key.agg(F.sum((F.col("all") - F.col("top")) * F.col("all"))).first()[0] or 0


def _rest_pairs(tagged: DataFrame, candidates: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) that share a bucket, are in different components, can
    reach the threshold and survive the comparison of long signatures.

    With u(x) shingles of x that no other candidate has, a pair shares at most
    i = min(|x| - u(x), |y| - u(y)) and has at least i + u(x) + u(y) together.
    It follows that the one with the smaller u is *light*: twice its u fits
    into the allowed difference, so every such pair has a light side.
    """
    several = tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter("lo != hi").select("key")
    mixed = materialize(tagged.join(several, "key"), "dups-mixed")
    single = (
        sets.join(few(mixed.select("node").distinct()), "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).filter(F.col("n") == 1)
        .groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    )
    slack = denominator - numerator
    common = F.col("size") - F.col("own")
    mixed = (
        mixed.join(materialize(single, "dups-own"), "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
        .filter(F.col("own") * numerator <= common * slack)
        .withColumn("light", F.col("own") * 2 * numerator <= common * slack)
    )
    mixed = materialize(mixed, "dups-open")

    chosen = few(mixed.select("node").distinct())
    long_signatures = materialize(_long_signatures(
        sets.join(chosen, "node", "left_semi").join(candidates, "node")), "dups-long")
    return _compare_blocks(mixed, long_signatures, numerator, denominator)


def _long_signatures(sets: DataFrame) -> DataFrame:
    """(node, keys, long_signature): the low halves of the band keys, and one
    bit of each of ``LONG_HASHES`` MinHash values."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy().view(np.uint64)
            rows = [np.packbits((signature(values[at[r]:at[r + 1]], LONG_HASHES) >> np.uint32(13)) & np.uint32(1)).tobytes()
                    for r in range(batch.num_rows)]
            keys = [band_keys(np.frombuffer(x, dtype=np.uint32)[None])[0].astype(np.int32).tobytes()
                    for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())],
                                             names=["node", "keys", "long_signature"])

    return sets.select("node", "shingles", "signature").mapInArrow(
        build, "node long, keys binary, long_signature binary")


def _compare_blocks(rows: DataFrame, signatures: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) of each bucket that pass the size bounds and survive
    the sequential comparison of long signatures. A large bucket is cut into
    blocks by a hash of the node, and every two of its blocks meet in a step
    of their own, so neither a task nor a shuffle ever holds its pairs."""
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("light").alias("any_light"),
                                      F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter("any_light and lo != hi").select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")).cast("int")
    steps = (
        rows.join(counts, "key").withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
        .join(signatures, "node")
        .select("key", "first", "second", "block", "node", "size", "own", "component", "light",
                "keys", "long_signature")
        .repartition("key", "first", "second").sortWithinPartitions("key", "first", "second")
    )
    # Single bits also agree by chance, half of the time.
    least = least_matches((1 + numerator / denominator) / 2, LONG_BATCHES)
    slack = denominator - numerator

    def step(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        first, second, block, node, size, own, component, light = (
            rows.column(c).to_numpy() for c in range(1, 9))
        keys = np.frombuffer(b"".join(rows.column(9).to_pylist()), dtype=np.int32).reshape(len(node), -1)
        bits = np.frombuffer(b"".join(rows.column(10).to_pylist()), dtype=np.uint64).reshape(-1, LONG_HASHES // 64)
        here = int(np.flatnonzero((keys == np.int64(rows.column(0)[0].as_py()).astype(np.int32)).all(axis=0))[0])
        within = first[0] == second[0]
        for x in np.flatnonzero(light):
            # A pair of two light rows is met from both; the smaller node has it.
            meets = (component != component[x]) & (~light | (node > node[x]))
            if not within:
                meets &= block != block[x]
            most = np.minimum(size - own, size[x] - own[x])
            meets &= (own + own[x]) * numerator <= most * slack
            meets &= np.minimum(size, size[x]) * denominator >= np.maximum(size, size[x]) * numerator
            alive = np.flatnonzero(meets)
            # A pair belongs to the first bucket that it shares.
            alive = alive[~(keys[alive, :here] == keys[x, :here]).any(axis=1)]
            matches, done = np.zeros(len(alive), dtype=np.int64), 0
            for n, fewest in least:
                if not len(alive):
                    break
                differ = np.bitwise_count(bits[alive, done // 64:n // 64] ^ bits[x, done // 64:n // 64])
                matches = matches + (n - done) - differ.sum(axis=1, dtype=np.int64)
                done = n
                alive, matches = alive[matches >= fewest], matches[matches >= fewest]
            if len(alive):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(node[alive], node[x])), pa.array(np.maximum(node[alive], node[x]))],
                    names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            marks = np.stack([table.column(c).to_numpy() for c in range(3)])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            begin = 0
            for cut in cuts.tolist():
                if cut - begin > 1:
                    yield from step(table.slice(begin, cut - begin))
                begin = cut
            held = table.slice(begin)
        if held is not None and held.num_rows > 1:
            yield from step(held)

    return steps.mapInArrow(compare, "a long, b long").distinct()
