"""Periodic runs of words: stretches that repeat one passage several times over.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least ``max(least_words, least_exponent * q)``
that no neighbouring word extends with the same period.

Method: internal pattern matching. The words, cut at power-of-two borders, give
dyadic blocks. For each block of length B the nearest equal stretches of words
in the windows of B words to its left and right are looked up by a range
successor (and predecessor) query: the suffix array lists a block's occurrences
as one interval, and a wavelet tree over it answers "next position after x in
this interval". Occurrence and block are two terms of an arithmetic
progression, whose step is a candidate period. Extending the step both ways
gives the whole stretch.

Why nothing is missed (exponent 4 or more): take a run [s, e) with smallest
period q and the level with q <= B < 2q. No occurrence of a block inside the
run is nearer than q (two periods that short would have a common divisor as
period). A block that starts in [s, e - q - B] is found again at +q, one that
starts in [s + q, e - B] at -q, and the two ranges together are longer than B,
so a block border falls into them.

Before that, an exact filter drops what cannot be in a run: each sequence of
three words inside a run occurs several times within it, so stretches whose
sequences occur less often are cut, again and again while that pays. What
is left of ordinary prose is little. The counts are taken in a hash table of
fixed width, where a collision only keeps more words.

Work is done per Arrow batch, on all its documents at once; a document is never
split, and the memory is about 100 bytes a word that survives the filter.

Defined results: a null text counts as empty; texts without words have no runs
and an empty collapsed text; ids may be null or repeat, each row is handled for
itself; columns other than the id and the text are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LEAST_WORDS = 6
LEAST_EXPONENT = 4
# Buckets of the filter's counts, as a power of two.
TABLE_BITS = 20
# The filter stops once a round keeps this share of what was left.
ENOUGH = 0.95
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
                dtype=np.uint64)


# ----------------------------------------------------------------- the filter

def repetitive_stretches(ids: np.ndarray, doc: np.ndarray, least_words: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the stretches of word positions that may hold runs;
    every run lies within one of them. ``doc`` numbers the document of each word."""
    least = min(least_words - 2, least_exponent - 1)  # times that three words of a run occur in it
    if len(ids) < least_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = ids.astype(np.uint64)
    triple = words[:-2] * _ODD[0] + words[1:-1] * _ODD[1] + words[2:] * _ODD[2]
    at = np.flatnonzero(doc[:-2] == doc[2:])
    part = doc[at].astype(np.uint64)
    while len(at):
        mixed = (triple[at] + part * _ODD[3]) * _ODD[4]
        bucket = (mixed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        good = np.bincount(bucket, minlength=1 << TABLE_BITS)[bucket] >= least
        kept, kept_part = at[good], part[good]
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) != 1) | (kept_part[1:] != kept_part[:-1])
        number = np.cumsum(new) - 1
        long = np.bincount(number, minlength=1)[number] >= least_words - 2 if len(kept) else good[:0]
        before, at, part = len(at), kept[long], number[long].astype(np.uint64)
        if len(at) >= ENOUGH * before:
            break
    begins = np.flatnonzero(np.append(True, np.diff(part.astype(np.int64)) != 0)) if len(at) else at
    return at[begins], at[np.append(begins[1:], len(at)).astype(np.int64) - 1] + 3 if len(at) else at


# --------------------------------------------- suffix array and wavelet tree

def prefix_ranks(seq: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``seq`` and, for each power of two B until all are
    distinct, the number of suffixes that are smaller in their first B words."""
    n = len(seq)
    key, width, levels = seq.astype(np.int64), 1, []
    while True:
        order = np.argsort(key, kind="stable")
        first = np.ones(n, bool)
        first[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        levels.append(rank.astype(np.int32))
        if first.all():
            return order, levels
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        width *= 2


class WaveletTree:
    """Wavelet tree of a permutation (in matrix form): order statistics of any
    interval of it, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def smaller(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the values in [lo, hi) are smaller than ``value``."""
        count = np.zeros(len(lo), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            lo0, hi0 = zeros[lo], zeros[hi]
            count += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, lo - lo0 + zeros[-1], lo0), np.where(one, hi - hi0 + zeros[-1], hi0)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values in [lo, hi)."""
        value = np.zeros(len(lo), np.int64)
        for level, zeros in enumerate(self.zeros):
            lo0, hi0 = zeros[lo], zeros[hi]
            one = k >= hi0 - lo0
            value |= one.astype(np.int64) << (self.bits - 1 - level)
            k = np.where(one, k - (hi0 - lo0), k)
            lo, hi = np.where(one, lo - lo0 + zeros[-1], lo0), np.where(one, hi - hi0 + zeros[-1], hi0)
        return value


# ------------------------------------------------------------------ the runs

def _candidates(levels: list[np.ndarray], tree: WaveletTree, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, q): positions that start equal words at i and i + q, for the nearest
    occurrences of every dyadic block in its neighbouring windows."""
    found = []
    for k, rank in enumerate(levels):
        block = 1 << k
        x = np.arange(0, n - block + 1, block)
        lo = rank[x].astype(np.int64)
        size = np.bincount(rank, minlength=n)[lo]
        x, lo, size = x[size > 1], lo[size > 1], size[size > 1]
        if not len(x):
            continue
        hi, before = lo + size, tree.smaller(lo, lo + size, x)
        has = before + 1 < size
        right = tree.smallest(lo[has], hi[has], before[has] + 1)
        has_left = before > 0
        left = tree.smallest(lo[has_left], hi[has_left], before[has_left] - 1)
        i = np.concatenate([x[has], left])
        q = np.concatenate([right - x[has], x[has_left] - left])
        fits = (q <= block) & (2 * q > block)  # other periods belong to other levels
        found.append((i[fits], q[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _extended(levels: list[np.ndarray], n: int, i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest stretch [start, end) around i with period q, for every (i, q)."""
    # Words equal at two places are fewer than the width of the last level, where
    # all places are distinct: each level is due at most once.
    right, left = i.copy(), i.copy()
    for k in range(len(levels) - 1, -1, -1):
        rank, block = levels[k], 1 << k
        inside = right + q + block <= n
        same = inside & (rank[np.where(inside, right, 0)] == rank[np.where(inside, right + q, 0)])
        right = right + np.where(same, block, 0)
        inside = left >= block
        back = inside & (rank[np.where(inside, left - block, 0)] == rank[np.where(inside, left - block + q, 0)])
        left = left - np.where(back, block, 0)
    return left, right + q


def runs_of(seq: np.ndarray, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> np.ndarray:
    """The runs of ``seq`` as rows (start, end, period), by start, then period."""
    n = len(seq)
    if n < least_words:
        return np.zeros((0, 3), np.int64)
    order, levels = prefix_ranks(seq)
    i, q = _candidates(levels, WaveletTree(order), n)
    start, end = _extended(levels, n, i, q)
    fits = end - start >= np.maximum(least_words, least_exponent * q)
    rows = np.stack([start[fits], end[fits], q[fits]], axis=1)
    # A stretch that several periods fit is one run, of the smallest.
    rows = np.unique(rows, axis=0)
    rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))] if len(rows) else rows
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def document_runs(ids: np.ndarray, doc: np.ndarray, least_words: int, least_exponent: int) -> np.ndarray:
    """The runs of many documents as rows (begin, end, period) of positions in
    ``ids``. The stretches that may hold runs are searched together, kept
    apart by words that occur once."""
    begins, ends = repetitive_stretches(ids, doc, least_words, least_exponent)
    if not len(begins):
        return np.zeros((0, 3), np.int64)
    sizes = ends - begins
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(begins)), sizes + 1)
    place = np.arange(starts[-1]) - starts[owner]
    last = place == sizes[owner]
    source = np.where(last, 0, begins[owner] + place)
    seq = np.where(last, int(ids.max()) + 1 + owner, ids[source])
    rows = runs_of(seq, least_words, least_exponent)
    shift = begins[owner[rows[:, 0]]] - starts[owner[rows[:, 0]]]
    rows[:, 0] += shift
    rows[:, 1] += shift
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


RUNS = "array<struct<start: long, length: long, period: long>>"


def collapse_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, text) for every row of ``docs``: the runs of its
    text by start, then period, in word numbers from 0, and the text without
    repetitions: of each run only the first period is kept, words joined by
    one space."""
    if least_exponent < 4 or least_words < 3:
        raise ValueError("runs are found from an exponent of 4 and three words on")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            lists = pc.ascii_split_whitespace(pc.fill_null(batch.column(1), ""))
            flat, doc = lists.flatten(), np.repeat(np.arange(rows), pc.list_value_length(lists).to_numpy())
            full = pc.greater(pc.binary_length(flat), 0)
            flat, doc = flat.filter(full), doc[full.to_numpy(zero_copy_only=False)]
            ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            runs = document_runs(ids, doc, least_words, least_exponent)
            first = np.searchsorted(doc, np.arange(rows + 1))
            owner = doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
            # Words after the first period of a run that holds them go.
            cover = np.zeros(len(ids) + 1, np.int64)
            np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
            np.add.at(cover, runs[:, 1], -1)
            keep = np.cumsum(cover[:-1]) == 0
            kept = np.concatenate([[0], np.cumsum(keep)])[first]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(keep))), " ")
            begin = runs[:, 0] - first[owner]
            items = pa.StructArray.from_arrays(
                [pa.array(begin), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"])
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32()), items)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first), pa.int64()), found, text], names=["doc_id", "n_words", "runs", "text"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, n_words long, runs {RUNS}, text string")
