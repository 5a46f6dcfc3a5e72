"""Document fingerprints by SimHash, and search within a Hamming radius.

The terms of a text are its words and word pairs. Each votes with the signs of
the 128 bits of its hash, weighted by word length (short words say little); the
fingerprint keeps the sign of each sum. Likeness is the share of equal bits.

Search uses block tables: the 32 hex digits are cut into so many blocks that
two fingerprints within the radius differ by at most one bit in some block (six
blocks for a radius of 11). Each fingerprint is in the tables once per block,
and a query probes every block as it is and with each single bit flipped, so
all neighbours are candidates; they are compared bit by bit. Equal fingerprints
are one row with a count, so a large group of copies is one entry in each
table. Where the probes are too many to broadcast, block keys with many pairs
are cut into parts.

The radius is measured on lightly edited copies (README): 3 bits hold half of
the copies with one replaced word, 11 bits 95 %.

Defined results: a null text is empty; a text without words has the
fingerprint of zeros; equal texts have equal fingerprints; rows that repeat a
doc_id are ordered by text; a null doc_id sorts first; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .word_hashes import mix, shingle_hashes, sized_word_hashes

BITS = 128
DIGITS = BITS // 4
# Bits within which lightly edited copies stay, and bits of (almost) equal texts.
RADIUS = 11
COPY_RADIUS = 3
# Query keys up to which the search broadcasts them (about 100 bytes each).
BROADCAST_KEYS = 500_000
# Candidate pairs of one block key above which it is cut into parts.
PART_PAIRS = 2_000_000

_SIGNS = ((np.arange(256)[:, None] >> np.arange(8)) & 1) * 2.0 - 1.0
_SALTS = mix(np.arange(1, BITS // 64 + 1, dtype=np.uint64))


def fingerprint(text: str) -> bytes:
    """The 16 bytes of the fingerprint of a text."""
    words, sizes = sized_word_hashes(text)
    if not len(words):
        return bytes(BITS // 8)
    weights = np.clip(sizes - 2.0, 0.5, 8.0)
    if len(words) > 1:
        terms = np.concatenate([words, shingle_hashes(words, 2)])
        weights = np.concatenate([weights, (weights[1:] + weights[:-1]) / 2])
    else:
        terms = words
    votes = []
    for salt in _SALTS:
        hashes = mix(terms + salt).view(np.uint8).reshape(-1, 8)
        # The votes of eight bits at a time, from the weights of the 256 bytes.
        votes += [np.bincount(hashes[:, b], weights=weights, minlength=256) @ _SIGNS for b in range(8)]
    return np.packbits(np.concatenate(votes) > 0).tobytes()


def likeness(x: bytes, y: bytes) -> float:
    return 1.0 - (int.from_bytes(x) ^ int.from_bytes(y)).bit_count() / BITS


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of another."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_RESULT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_RESULT_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _result(doc_id: int | None, text: str, own: bytes, following: str, other: bytes) -> tuple:
    edited = edit(text, following)
    changed = own if edited == text else fingerprint(edited)
    digest = sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own.hex(), changed.hex(), likeness(own, changed), likeness(own, other)


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text (its last quarter
    replaced from the next document in doc_id order, after the last: the
    first), and their likeness.

    Documents are dealt by ranges of doc_id and sorted in their task, where
    each row meets the next. Only the first and the last row of a task are
    set aside; the last ones meet the first rows of the next ranges in a
    second step over a few rows per task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    names = [*_RESULT_NAMES, "part", "place", "text"]
    types = [*_RESULT_TYPES, pa.int32(), pa.string(), pa.string()]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = None  # the last document seen: id, text, fingerprint

        def border(place: str) -> tuple:
            return (held[0], *[None] * 6, part, place, held[1])

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = held[2] if held is not None and held[1] == text else fingerprint(text)
                previous, held = held, (doc_id, text, own)
                if previous is None:
                    rows.append(border("first"))
                else:
                    rows.append((*_result(*previous, text, own), part, "row", None))
            yield _batch(rows, types, names)
        if held is not None:
            yield _batch([border("last")], types, names)

    walked = materialize(
        ordered.mapInArrow(walk, f"{_RESULT}, part int, place string, text string"), "simhash-walked")
    firsts = walked.filter("place = 'first'").select("part", F.col("text").alias("following"))
    # One row per task, so the global window sees a small table.
    by_part = Window.orderBy("part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turns = firsts.select("part").select(
        "part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(everything)).alias("next_part"))
    borders = (
        walked.filter("place = 'last'").select("part", "doc_id", "text").join(turns, "part")
        .join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "following")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_result(doc_id, text, fingerprint(text), following, fingerprint(following))
                    for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in range(3)))]
            yield _batch(rows, _RESULT_TYPES, _RESULT_NAMES)

    return walked.filter("place = 'row'").select(*_RESULT_NAMES).unionByName(borders.mapInArrow(meet, _RESULT))


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


# ------------------------------------------------------------------ search

def _blocks(radius: int) -> tuple[list[tuple[int, int]], int]:
    """(begin, digits) of the blocks, of 32 bits at most, and the most bits by
    which some block differs (0 or 1)."""
    n = max(4, radius // 2 + 1)
    edges = [round(i * DIGITS / n) for i in range(n + 1)]
    return [(b, e - b) for b, e in zip(edges, edges[1:])], radius // n


def _number(name: str, begin: int, digits: int) -> Column:
    return F.conv(F.substring(name, begin + 1, digits), 16, 10).cast("long")


def _keys(name: str, radius: int) -> list[Column]:
    """The key of a fingerprint in each block table."""
    return [_number(name, b, d) + F.lit(t << 32) for t, (b, d) in enumerate(_blocks(radius)[0])]


def _probes(name: str, radius: int) -> Column:
    """The keys a query asks for: its own and, if need be, those one bit off."""
    blocks, off = _blocks(radius)
    flips = [F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(4 * d * off)]) for _, d in blocks]

    def flipped(key: Column, bits: Column) -> Column:
        return F.transform(bits, lambda bit: key.bitwiseXOR(bit))

    return F.concat(*[flipped(k, f) for k, f in zip(_keys(name, radius), flips)])


def _halves(name: str, prefix: str) -> list[Column]:
    return [F.shiftleft(_number(name, at, 8), 32).bitwiseOR(_number(name, at + 8, 8)).alias(f"{prefix}{at}") for at in (0, 16)]


def near(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint, distance, rows): for each distinct fingerprint of
    ``queries``, all distinct ones of ``fingerprints`` within the radius (its
    own included), how many bits differ and how many rows have it."""
    if not 0 <= radius < 2 * DIGITS:
        raise ValueError(f"radius {radius} is not within 0 and {2 * DIGITS - 1}")
    table = fingerprints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows"))
    wanted = queries.select(F.col("fingerprint").alias("query")).distinct()
    probes = materialize(
        wanted.select("query", *_halves("query", "q"), F.explode(_probes("query", radius)).alias("key")), "simhash-queries")
    entries = table.select("fingerprint", "rows", *_halves("fingerprint", "f"),
                           F.explode(F.array(*_keys("fingerprint", radius))).alias("key"))
    if probes.count() <= BROADCAST_KEYS:
        candidates = entries.join(F.broadcast(probes), "key")
    else:
        candidates = _join_in_parts(materialize(entries, "simhash-entries"), probes)
    distance = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"q{at}").bitwiseXOR(F.col(f"f{at}"))) for at in (0, 16)])
    return (
        candidates.select("query", "fingerprint", distance.cast("int").alias("distance"), "rows")
        .filter(F.col("distance") <= radius).distinct()
    )


def _join_in_parts(entries: DataFrame, probes: DataFrame) -> DataFrame:
    """Join by key, where the entries of a key with many pairs are dealt to
    parts, and its probes go to each of them."""
    def sizes(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("key").agg(F.count(F.lit(1)).alias(name))

    hot = (
        sizes(entries, "n_entries").join(sizes(probes, "n_probes"), "key")
        .filter(F.col("n_entries") * F.col("n_probes") > PART_PAIRS)
        .select("key", F.least("n_entries", F.ceil(F.col("n_entries") * F.col("n_probes") / PART_PAIRS)).cast("int").alias("parts"))
    )
    hot = F.broadcast(materialize(hot, "simhash-hot"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = entries.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("fingerprint"), parts).cast("int"))
    asked = probes.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.drop("parts").join(asked.drop("parts"), ["key", "part"])


def near_documents(rows: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query_id, doc_id, distance): for each document of ``queries``, every
    other document of ``rows`` within the radius. Both have doc_id and
    fingerprint; rows that repeat a doc_id and fingerprint count once, and a
    document is no neighbour of its own id."""
    found = materialize(near(rows, queries, radius).drop("rows"), "simhash-near")
    asked = queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("query")).distinct()
    return (
        rows.select("doc_id", "fingerprint").distinct().join(found, "fingerprint").join(asked, "query")
        .filter(~F.col("doc_id").eqNullSafe(F.col("query_id")))
        .groupBy("query_id", "doc_id").agg(F.min("distance").alias("distance"))
    )


def count_near(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, n_near): for each distinct fingerprint of ``queries``, how
    many rows of ``fingerprints`` lie within the radius (itself included)."""
    pairs = near(fingerprints, queries, radius)
    return pairs.groupBy("query").agg(F.sum("rows").alias("n_near")).withColumnRenamed("query", "fingerprint")
