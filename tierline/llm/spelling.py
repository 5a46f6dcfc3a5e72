"""Spelling variants: words that differ by one edit, found through a reduced alphabet.

Every letter is hashed to one of a few symbols, which turns a word into a
reduced word. If two words are one edit apart, their reduced words are equal
or one edit apart, so the full one-edit neighbourhood of each reduced word,
over the few symbols only, joined with the reduced vocabulary finds every
pair. What it finds is verified on the words themselves.

All steps are DataFrame functions. Sizes:

* occurrences are counted per word before they are shuffled, so a frequent word
  costs one row per task;
* neighbourhoods are made once per reduced word, as 64-bit hashes (a hash that
  two share costs a failed verification, nothing else);
* the number of symbols grows with the vocabulary (:func:`symbols_for`), so
  the words that share a reduced word, and with them the pairs to verify per
  word, stay about as many;
* a word of L letters has a bounded number of words one edit away, so no group
  of near words grows with the data.

Defined results: a null text has no runs, a null id counts as empty text where
the id is hashed, rows that repeat are counted as often as they occur, words
of equal count are ordered by code points, an empty table gives no words.
Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
RUN = f"[A-Za-z{ACCENTED[0]}-{ACCENTED[-1]}]"

# Knuth's multiplier, to spread neighbouring code points over the symbols.
MULTIPLIER = 2654435761
# Cells that a reduced alphabet offers to the shortest words, per word.
CELLS_PER_WORD = 1
MIN_SYMBOLS, MAX_SYMBOLS = 4, 32


def letter_runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """(doc_id, run): the maximal runs of at least ``least`` letters of every
    whole text, with A-Z lower-cased and accented letters left as they are."""
    found = F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{least},}}"), F.lit(0)))
    run = F.col("run")
    plain = F.octet_length(run) == F.length(run)  # ASCII only, where lower() changes A-Z alone
    lowered = F.when(plain, F.lower(run)).otherwise(F.translate(run, UPPER, UPPER.lower()))
    return docs.select("doc_id", found.alias("run")).select("doc_id", lowered.alias("run"))


def drop_letter(word: Column, at: Column) -> Column:
    """``word`` without the code point at ``at`` (from 0)."""
    return F.concat(word.substr(F.lit(1), at.cast("int")), word.substr((at + 2).cast("int"), F.length(word)))


def count_words(runs: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words in the column ``run``."""
    return runs.filter(F.length("run") >= min_length).groupBy(F.col("run").alias("word")) \
        .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def symbols_for(vocabulary: int, min_length: int) -> int:
    """Symbols with which words of ``min_length`` have ``CELLS_PER_WORD`` cells
    for each word of the vocabulary."""
    wanted = math.ceil((CELLS_PER_WORD * max(vocabulary, 1)) ** (1 / max(min_length, 1)))
    return min(max(wanted, MIN_SYMBOLS), MAX_SYMBOLS)


def _alphabet(symbols: int) -> str:
    return "".join(chr(ord("0") + i) for i in range(symbols))


def reduced(word: Column, symbols: int) -> Column:
    """``word`` with each letter hashed to one of ``symbols`` symbols."""
    letters, alphabet = UPPER.lower() + ACCENTED, _alphabet(symbols)
    return F.translate(word, letters, "".join(alphabet[(ord(c) * MULTIPLIER >> 16) % symbols] for c in letters))


def neighbourhood(word: Column, symbols: int) -> Column:
    """Hashes of ``word`` and of every word over the alphabet one inserted,
    deleted or replaced symbol away."""
    alphabet = F.array(*[F.lit(s) for s in _alphabet(symbols)])
    size = F.length(word)

    def spliced(at: Column, middle: Column | None, skip: int) -> Column:
        parts = [word.substr(F.lit(1), at), *([] if middle is None else [middle]), word.substr(at + 1 + skip, size)]
        return F.xxhash64(F.concat(*parts))

    places = F.sequence(F.lit(0), size - 1)
    deleted = F.transform(places, lambda i: spliced(i, None, 1))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(alphabet, lambda s: spliced(i, s, 1))))
    inserted = F.flatten(F.transform(F.sequence(F.lit(0), size), lambda i: F.transform(alphabet, lambda s: spliced(i, s, 0))))
    return F.array_distinct(F.concat(F.array(F.xxhash64(word)), deleted, replaced, inserted))


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words exactly one edit
    apart. ``words`` (word, n) holds each word once, none of them empty."""
    keyed = words.withColumn("reduced", reduced(F.col("word"), symbols)).withColumn("cell", F.xxhash64("reduced"))
    cells = keyed.select("cell").distinct()
    # Few bytes that become many rows: dealt to as many tasks as there are
    # partitions, not merged into a few by their size.
    spark = words.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    around = keyed.select("reduced").repartition(tasks, "reduced").distinct().select(
        F.xxhash64("reduced").alias("cell"), F.explode(neighbourhood(F.col("reduced"), symbols)).alias("near_cell"))
    cell_pairs = around.join(cells.withColumnRenamed("cell", "near_cell"), "near_cell")
    others = keyed.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("cell").alias("near_cell"))
    pairs = keyed.select("word", "n", "cell").join(cell_pairs, "cell").join(others, "near_cell")
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def spelling_groups(words: DataFrame, ratio: int = 5, symbols: int | None = None) -> DataFrame:
    """Group the spelling variants of a vocabulary ``words`` (word, n).

    Returns (word, form, root, n, n_near, form_n): ``form`` is the near word of
    largest count (ties: the smallest in code-point order) where that count is
    at least ``ratio`` times the word's own, else null; ``root`` the last word
    reached by following forms, the word itself if it has none; ``n_near`` the
    number of near words.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = materialize(words.select("word", "n"), "spelling-words")
    size, most, shortest = words.agg(F.count(F.lit(1)), F.max("n"), F.min(F.length("word"))).first()
    pairs = near_words(words, symbols or symbols_for(size, shortest or 1))
    # The best near word: largest n, then smallest word.
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    counted = words.join(best, "word", "left")
    takes = -F.col("best.minus_n") >= F.lit(ratio) * F.col("n")
    formed = materialize(counted.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.minus_n")).alias("form_n"),
    ), "spelling-forms")
    roots = _roots(formed.filter("form is not null").select("word", F.col("form").alias("root")), most or 1, ratio)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for (word, root) links that each lead to a word at least
    ``ratio`` times as frequent. A chain has at most log(most) links to that
    base, and every round doubles the links followed."""
    hops, longest = 1, 1 + int(math.log(most, ratio))
    while hops < longest:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = materialize(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                            "spelling-roots")
        hops *= 2
    return links
