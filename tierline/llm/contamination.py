"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask over 8 successive words, of which 6 count and 2 are
ignored, so it still matches where a word was exchanged. The two masks are
chosen so that any window of 13 words with at most two exchanged words is hit
by one of them at some place (a test tries all such windows). Items of 8 to 12
words have masks over all their words, chosen by length so that every allowed
pattern of exchanged words is hit (a test tries all); shorter items have one
mask that counts every word. Test items and training texts are hashed under
every mask at every place and joined by hash; around each hit the words are
compared on the diagonal, and a document is contaminated by an item if some
window of 13 words agrees in at least 11 (for items of 8 to 12 words: of all
their words, in 80 %; for shorter ones: in all). Masks of short items cost
nothing where the benchmark has no item of that length.

Words are runs of letters, marks and digits, lower-cased, so punctuation, case
and spacing of any script do not hide a copy. Of scripts written without
spaces (Chinese, Japanese, Thai and the like) each letter with its marks is a
word.

The join is prepared by a bit table of fixed size over the test hashes. It is
at most 2 MB however large the benchmark is; it only spares the join those
training hashes that no test item has, and grows less selective, not wrong.
Of the texts, only the neighbourhoods of hits leave the scan.

Defined results: null and empty texts or items, and items without a word,
contaminate nothing; a null doc_id can be contaminated and is told apart by its
text; rows that repeat a doc_id and text count once; ties between places go to
the first one; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, small_batches
from .word_hashes import PUNCTUATION, mix, spaced_words, word_hashes

MASKS = ("11110011", "11010111")
WINDOW, LEAST_EQUAL = 13, 11
SHORT_SHARE = 0.8
TABLE_BITS = 24
# Test seeds up to which the join broadcasts them (24 bytes each).
BROADCAST_SEEDS = 1_000_000
SPAN = len(MASKS[0])


def words_of(text: str | None) -> np.ndarray:
    return word_hashes(spaced_words(text.lower()), PUNCTUATION) if text else np.empty(0, dtype=np.uint64)


def needed(length: int) -> tuple[int, int]:
    """(window, fewest equal words) for an item of ``length`` words."""
    if length >= WINDOW:
        return WINDOW, LEAST_EQUAL
    return length, int(np.ceil(SHORT_SHARE * length)) if length >= SPAN else length


def _short_masks(length: int) -> tuple[str, ...]:
    """Masks over all words of an item below a window: greedily those that
    miss most of the exchange patterns left, until each pattern is missed by
    the counted words of some mask."""
    exchanged = length - needed(length)[1]
    if not exchanged:
        return ("1" * length,)
    ignored = length - (6 if exchanged == 1 else 5)
    left = {frozenset(bad) for bad in combinations(range(length), exchanged)}
    out = []
    while left:
        best = max(combinations(range(length), ignored), key=lambda gaps: sum(bad <= set(gaps) for bad in left))
        left = {bad for bad in left if not bad <= set(best)}
        out.append("".join("0" if i in best else "1" for i in range(length)))
    return tuple(out)


SHORT_MASKS = {n: _short_masks(n) for n in range(1, WINDOW)}


def masks_of(length: int) -> tuple[str, ...]:
    """The masks of an item of ``length`` words."""
    return MASKS if length >= WINDOW else SHORT_MASKS.get(length, ())


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every place under a mask."""
    places = max(len(words) - len(mask) + 1, 0)
    out = np.zeros(places, dtype=np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ words[j:j + places]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * j + 1)
    return mix(out + np.uint64(int(mask, 2) << 4 | len(mask)))


def test_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, seeds[(hash, place)]) of every usable item."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            seeds = [[{"hash": h, "place": p} for mask in masks_of(len(w))
                      for p, h in enumerate(seed_hashes(w, mask).view(np.int64).tolist())] for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()),
                 pa.array(seeds, pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())])))],
                names=["item_id", "words", "seeds"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        build, "item_id long, words binary, seeds array<struct<hash: long, place: int>>")


def _bit_table(seeds: DataFrame) -> np.ndarray:
    """Which hash slots the test seeds use: 2^24 bits, gathered as words of 64
    bits, so the driver gets 2^18 rows at most."""
    slot = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    rows = seeds.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(hash, 40) & 63 as int))")).alias("bits")).collect()
    table = np.zeros(2 ** (TABLE_BITS - 6), dtype=np.int64)
    for r in rows:
        table[r["word"]] = r["bits"]
    return table.view(np.uint64)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, start, length, equal), one row per document
    text and item: the longest agreeing stretch, in words of the document.
    ``text_key`` is ``xxhash64(text)``."""
    spark = docs.sparkSession
    small_batches(spark)
    items = materialize(test_items(benchmark), "leaks-items")
    seeds = items.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.hash", F.col("s.place").alias("item_place"))
    table = spark.sparkContext.broadcast(_bit_table(seeds))
    length = F.least(F.octet_length("words") / 8, F.lit(WINDOW)).cast("int")
    masks = sorted({mask for r in items.select(length.alias("n")).distinct().collect() for mask in masks_of(r["n"])})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The neighbourhoods of places whose hash may be a test seed."""
        shift, low = np.uint64(64 - TABLE_BITS), np.uint64(63)
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                words = words_of(text)
                at, seen = [], []
                for mask in masks:
                    hashes = seed_hashes(words, mask)
                    slots = hashes >> shift
                    hit = np.flatnonzero((table.value[slots >> np.uint64(6)] >> (slots & low)) & np.uint64(1))
                    at.append(hit)
                    seen.append(hashes[hit].view(np.int64))
                if not sum(map(len, at)):
                    continue
                places, hashes = np.concatenate(at), np.concatenate(seen)
                order = np.argsort(places, kind="stable")
                places, hashes = places[order], hashes[order]
                cuts = np.flatnonzero(np.diff(places) > SPAN + 2 * WINDOW) + 1
                for group, keys in zip(np.split(places, cuts), np.split(hashes, cuts)):
                    begin = max(0, int(group[0]) - WINDOW)
                    end = min(len(words), int(group[-1]) + SPAN + WINDOW)
                    found = [{"hash": h, "place": p - begin} for p, h in zip(group.tolist(), keys.tolist())]
                    rows.append((doc_id, key, begin, words[begin:end].tobytes(), found))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(),
                     pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "text_key", "begin", "region", "seeds"])

    scanned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    regions = materialize(scanned.mapInArrow(
        scan, "doc_id long, text_key long, begin long, region binary, "
              "seeds array<struct<hash: long, place: int>>"), "leaks-regions")

    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    place = ["doc_id", "text_key", "begin"]
    pairs = (
        regions.select(*place, F.explode("seeds").alias("s")).select(*place, "s.hash", F.col("s.place").alias("place"))
        .join(seeds, "hash").select(*place, "item_id", (F.col("place") - F.col("item_place")).alias("diagonal"))
        .distinct()
    )
    words = items.select("item_id", F.col("words").alias("item"))
    r = regions.select(*[F.col(c).alias(f"r_{c}") for c in place], "region").dropDuplicates([f"r_{c}" for c in place])
    same = F.lit(True)
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    lined_up = pairs.join(words, "item_id").join(r, same).select(*place, "item_id", "diagonal", "region", "item")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, begin, item_id, diagonal, region, item in zip(*(batch.column(c).to_pylist() for c in range(7))):
                found = overlap(np.frombuffer(region, dtype=np.uint64), np.frombuffer(item, dtype=np.uint64), diagonal)
                if found:
                    rows.append((doc_id, key, item_id, begin + found[0], found[1], found[2]))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns],
                                             names=["doc_id", "text_key", "item_id", "start", "length", "equal"])

    hits = lined_up.mapInArrow(
        verify, "doc_id long, text_key long, item_id long, start long, length long, equal long")
    return (
        hits.groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.struct("equal", (-F.col("length")).alias("l"), (-F.col("start")).alias("s"))).alias("b"))
        .select("doc_id", "text_key", "item_id", (-F.col("b.s")).alias("start"), (-F.col("b.l")).alias("length"),
                F.col("b.equal").alias("equal"))
    )


def overlap(region: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(start in the region, length, equal words) of the stretch covered by
    agreeing windows on a diagonal, or None if no window agrees."""
    begin, end = max(0, diagonal), min(len(region), diagonal + len(item))
    size, least = needed(len(item))
    if end - begin < size:
        return None
    equal = region[begin:end] == item[begin - diagonal:end - diagonal]
    sums = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(sums[size:] - sums[:-size] >= least)
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + size
    return begin + first, last - first, int(sums[last] - sums[first])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that a benchmark item contaminates."""
    doc_id, text_key = free_name(docs, "leak_doc_id"), free_name(docs, "leak_text_key")
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias(doc_id), F.col("text_key").alias(text_key)).distinct()
    bad = materialize(bad, "leaks-documents")
    kept = docs.join(
        bad,
        F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_key)),
        "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
