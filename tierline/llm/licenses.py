"""Licence scans: a trained classifier names the family, a template confirms it.

DataFrame functions only. A text is a sequence of words (lower-cased runs of
letters and digits) with their line numbers; comment marks at the head of a
line are no words, and no word pair reaches over a line without words. So a
notice is seen whole whether it stands on one line or is hard-wrapped. Features
are the word pairs of the labelled notices that are rare in ordinary text.

A *window* is a stretch of a text about as long as a notice (``WINDOW`` times
its words). A family is reported where one window passes both tests:

* the classifier names it: a sparse (L1) multinomial logistic regression over
  the pairs in the window and the few words before it gives the family, against
  unknown, a probability above the calibrated threshold, below which all but one
  in a thousand held-out unknown paragraphs stay for every family. Half of these are single lines, half wrapped
  runs of lines, among them notices of other licences, comparisons and
  negations;
* a template confirms it: the window holds at least 60 % of the pairs of a
  notice of the family, and at least 60 % of those that no other family has.

Training takes the notices of :mod:`license_templates`, alone and embedded in
ordinary text, and the ordinary paragraphs of the whole corpus (half of them
are held out). These are counted by the pairs of notices that they hold, in one
pass; a set of pairs is one example, its weight the number of paragraphs, and
all together weigh as much as ``ORDINARY_WEIGHT`` examples. Scanning covers every text whole, in one pass: a text that
holds none of the anchors (words of which every confirmed window must hold one,
derived from the notices) is done with a few substring searches; of the others
only the words pairs of notices leave the scan, with their places.

Defined results: a null or empty text, and any text without a licence, gives
no family (an empty string); a null id is an id like any other; ties between
notices go to the first by name; a family whose notices follow each other
within a window counts once there; repeated rows are each reported; long texts
are scanned whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize
from .license_templates import ORDINARY, OTHER, OTHER_HELD_OUT, TEMPLATES

UNKNOWN = "unknown"
# All ordinary paragraphs together weigh as much as so many examples in training.
ORDINARY_WEIGHT = 2000
EMBEDDINGS = 6
# A pair or word in more than this share of the ordinary paragraphs is no evidence.
COMMON_SHARE = 0.005
FALSE_ALARMS = 0.001
LEAST_PROBABILITY = 0.5
LEAST_OVERLAP = 0.6
WINDOW = 1.5
BLOCK = 64
# Words before a window that the classifier sees, too ("not licensed under ...").
CONTEXT = 4
PENALTY = 5e-4
# Each short notice is also taught as unknown with these before it.
NEGATIONS = ("This is not", "It was never", "It is no longer")
ANCHOR_LETTERS = 5
_CUES = "licen|copyright|spdx|creative commons|public domain|all rights|apache|gnu |mozilla"
_MARK = r"^[^\p{L}\p{N}]*(?:rem|dnl)\s"
_GAP = r"[^\p{L}\p{N}]+"
_WORD = re.compile(r"[^\W_]+")


def paragraphs(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per line of each text: ``keep``, its number and its text."""
    return docs.select(*keep, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("paragraph", "line"))


def _words(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), _MARK, ""), _GAP, " ")), " ")


def word_pairs(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """(keep, pos, line, pair): the hashes of successive words of each text
    with the number of the first word and its line. A line without words is an
    empty word, with which nothing pairs."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    words = F.flatten(F.transform(lines, lambda line, i: F.transform(
        _words(line), lambda word: F.struct(i.alias("line"), word.alias("word")))))
    # Through a generator, or the optimizer would split the text again for every pair.
    held = rows.select(*keep, F.explode(F.array(words)).alias("words"))
    pairs = F.expr("""filter(case when size(words) > 1 then transform(sequence(1, size(words) - 1), i -> struct(
        i - 1 as pos, words[i - 1].line as line,
        case when words[i - 1].word <> '' and words[i].word <> '' then xxhash64(words[i - 1].word, words[i].word) end as pair))
        else array() end, p -> p.pair is not null)""")
    return held.select(*keep, F.inline(pairs))


@dataclass
class Classifier:
    """``weights``: (pair, w[family]) per pair of the vocabulary; ``notices``:
    (pair, family, template, n_pairs, n_own, own, width) per pair of a notice;
    both are as small as the notices. ``anchors`` are substrings and patterns
    of lower-cased text, one of which every confirmed window holds."""

    families: list[str]
    intercepts: list[float]
    weights: DataFrame
    notices: DataFrame
    anchors: list[str]
    anchor_patterns: list[str]
    threshold: float = LEAST_PROBABILITY


def ordinary_lines(docs: DataFrame) -> DataFrame:
    """(line, place, held_out): the ordinary paragraphs of all documents, half
    of them held out; ``place`` orders them by a hash."""
    lines = paragraphs(docs.select("doc_id", "text"), "doc_id").filter((F.length("line") > 0) & ~F.lower("line").rlike(_CUES))
    place = F.xxhash64("line", "doc_id", "paragraph")
    return lines.select("line", place.alias("place"), (F.pmod(place, F.lit(2)) == 1).alias("held_out"))


def _half_wrapped(line: str, place: Column) -> Column:
    """``line``, for half of the places over lines of three words."""
    half = F.pmod(F.xxhash64(place), F.lit(2)) == 1
    return F.when(half, F.regexp_replace(line, "( [^ ]+ [^ ]+ [^ ]+) ", "$1\n")).otherwise(F.col(line))


def count_sets(lines: DataFrame, text: Column, pairs: list[int], words: list[str], *keep: str) -> DataFrame:
    """(keep, terms, named, n): how many ``lines`` hold which of ``pairs`` and
    ``words``. One pass over every line; what is alike is counted together."""
    split = F.flatten(F.transform(F.split(text, "\n"), _words))
    held = lines.select(*keep, F.explode(F.array(split)).alias("words"))  # see word_pairs
    less = F.size("words") - 1
    hashes = F.zip_with(F.slice("words", 1, less), F.slice("words", 2, less),
                        lambda a, b: F.when((a != "") & (b != ""), F.xxhash64(a, b)))
    return held.select(
        *keep, F.array_sort(F.array_distinct(F.filter(hashes, lambda p: p.isin(pairs)))).alias("terms"),
        F.array_sort(F.array_distinct(F.filter("words", lambda w: w.isin(words)))).alias("named"),
    ).groupBy(*keep, "terms", "named").agg(F.count(F.lit(1)).alias("n"))


def _wrapped(text: str) -> str:
    """``text`` over lines of about five words, as a comment."""
    words = text.split(" ")
    return "\n".join("// " + " ".join(words[i:i + 5]) for i in range(0, len(words), 5))


def _notices(spark: SparkSession, common: DataFrame) -> DataFrame:
    """The pairs of the notices: (pair, family, template, n_pairs, n_own, own, width)."""
    rows = [(f"{family}-{i}", family, text, math.ceil(WINDOW * len(_WORD.findall(text))))
            for family, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "template string, family string, line string, width int")
    pairs = word_pairs(frame.withColumnRenamed("line", "text"), "text", "template", "family", "width") \
        .select("template", "family", "width", "pair").distinct().join(common, "pair", "left_anti")
    families = pairs.groupBy("pair").agg((F.count_distinct("family") == 1).alias("own"))
    of_template = Window.partitionBy("template")
    return pairs.join(families, "pair").withColumns({
        "n_pairs": F.count(F.lit(1)).over(of_template), "n_own": F.count_if("own").over(of_template)})


def anchors_of(common_words: set[str], common_pairs: set[tuple[str, str]]) -> tuple[list[str], list[str]]:
    """Substrings and patterns of which every window with ``LEAST_OVERLAP`` of
    the pairs of a notice holds one: they are in so many pairs of each notice
    that those without one are too few. Words come first that are long, rare
    and in many notices; where a notice has too few of them, its pairs."""
    open_pairs: dict[str, tuple[set, int]] = {}
    for family, texts in TEMPLATES.items():
        for i, text in enumerate(texts):
            words = _WORD.findall(text.lower())
            pairs = {p for p in zip(words, words[1:]) if p not in common_pairs}
            if pairs:
                open_pairs[f"{family}-{i}"] = (pairs, math.ceil(LEAST_OVERLAP * len(pairs)))
    chosen, patterns = [], []
    while open_pairs := {t: (pairs, least) for t, (pairs, least) in open_pairs.items() if len(pairs) >= least}:
        gain: dict[str, int] = {}
        for pairs, _ in open_pairs.values():
            for word in {w for p in pairs for w in p}:
                if len(word) >= ANCHOR_LETTERS and word not in common_words:
                    gain[word] = gain.get(word, 0) + sum(word in p[0] or word in p[1] for p in pairs)
        if gain:
            best = max(sorted(gain), key=gain.get)
            chosen.append(best)
            open_pairs = {t: ({p for p in pairs if best not in p[0] and best not in p[1]}, least) for t, (pairs, least) in open_pairs.items()}
        else:
            pair = min(p for pairs, _ in open_pairs.values() for p in pairs)
            patterns.append(rf"{re.escape(pair[0])}{_GAP}{re.escape(pair[1])}")
            open_pairs = {t: (pairs - {pair}, least) for t, (pairs, least) in open_pairs.items()}
    return chosen, patterns


def train(docs: DataFrame) -> Classifier:
    """Train and calibrate on the notices and all ordinary paragraphs of ``docs``."""
    spark = docs.sparkSession
    ordinary = ordinary_lines(docs)
    taught = ORDINARY + OTHER + [f"{no} {text[0].lower()}{text[1:]}" for texts in TEMPLATES.values() for text in texts
                                 if text.startswith(("Licensed", "Released")) for no in NEGATIONS]
    notice_words = [_WORD.findall(t.lower()) for texts in TEMPLATES.values() for t in texts]
    labelled = spark.createDataFrame([(t,) for texts in TEMPLATES.values() for t in texts] + [(t,) for t in taught], "line string")
    labelled_pairs = sorted(r["pair"] for r in word_pairs(labelled, "line").select("pair").distinct().collect())  # of the notices
    text = F.when(F.col("held_out"), _half_wrapped("line", F.col("place"))).otherwise(F.col("line"))
    sets = materialize(count_sets(ordinary, text, labelled_pairs, sorted({w for ws in notice_words for w in ws}), "held_out"),
                       "license-ordinary")
    counted = {r["held_out"]: r["n"] for r in sets.groupBy("held_out").agg(F.sum("n").alias("n")).collect()}
    often = F.sum("n") > COMMON_SHARE * max(1, sum(counted.values()))
    common_words = {r["word"] for r in sets.select("n", F.explode("named").alias("word")).groupBy("word")
                    .agg(often.alias("c")).filter("c").collect()}  # of the notices
    common = materialize(sets.select("n", F.explode("terms").alias("pair")).groupBy("pair").agg(often.alias("c")).filter("c").select("pair"),
                         "license-common")
    notices = materialize(_notices(spark, common), "license-notices")
    named = spark.createDataFrame(sorted({p for w in notice_words for p in zip(w, w[1:])}), "a string, b string")
    common_pairs = {(r["a"], r["b"]) for r in named.withColumn("pair", F.xxhash64("a", "b")).join(common, "pair").collect()}
    chosen, patterns = anchors_of(common_words, common_pairs)

    families = sorted(TEMPLATES)
    labels = [UNKNOWN, *families]
    context = [r["line"] for r in ordinary.filter("not held_out").orderBy("place", "line").limit(EMBEDDINGS).collect()]
    examples = [(family, form) for family, texts in TEMPLATES.items() for text in texts
                for form in [text, *[f"{c} {text} {c}" for c in context]]]
    examples += [(UNKNOWN, form) for text in taught for form in [text, *[f"{c} {text} {c}" for c in context]]]
    examples += [(UNKNOWN, "") for _ in families]
    frame = spark.createDataFrame([(f"e{i}", labels.index(f), t) for i, (f, t) in enumerate(examples)],
                                  "id string, label int, line string")
    often_used = {r["pair"] for r in common.collect()}
    known = [p for p in labelled_pairs if p not in often_used]
    known_pairs = spark.createDataFrame([(p,) for p in known], "pair long")
    hits = word_pairs(frame, "line", "id").join(F.broadcast(known_pairs), "pair").groupBy("id") \
        .agg(F.sort_array(F.collect_set("pair")).alias("terms"))
    weighed = frame.select("id", "label").join(hits, "id", "left").groupBy("label", F.coalesce("terms", F.array().cast("array<long>")).alias("terms")) \
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    # Ordinary paragraphs that hold the same pairs are one example of their number's weight.
    share = min(1.0, ORDINARY_WEIGHT / max(1, counted.get(False, 0)))
    plain = sets.filter("not held_out").groupBy(F.filter("terms", lambda p: p.isin(known)).alias("terms")) \
        .agg((F.sum("n") * share).alias("weight")).select(F.lit(0).alias("label"), "terms", "weight")
    terms = weighed.unionByName(plain).select(
        F.col("label").cast("double").alias("label"), F.col("terms").cast("array<string>").alias("terms"), "weight")
    terms = materialize(terms.orderBy("label", "terms", "weight"), "license-terms")
    counter = CountVectorizer(inputCol="terms", outputCol="features", binary=True, minDF=1.0, vocabSize=1 << 16).fit(terms)
    model = LogisticRegression(family="multinomial", regParam=PENALTY, elasticNetParam=1.0, maxIter=60, weightCol="weight",
                               standardization=False).fit(counter.transform(terms))
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(int(term), [float(matrix[k][j] - matrix[0][j]) for k in range(1, len(labels))])
            for j, term in enumerate(counter.vocabulary)]
    weights = materialize(spark.createDataFrame(rows, "pair long, w array<double>"), "license-weights")
    classifier = Classifier(families, [float(b - intercepts[0]) for b in intercepts[1:]], weights, notices, chosen, patterns)
    classifier.threshold = max(LEAST_PROBABILITY, _highest_unknown(sets.filter("held_out"), classifier))
    return classifier


def _highest_unknown(ordinary: DataFrame, classifier: Classifier) -> float:
    """The probability that all but ``FALSE_ALARMS`` of the held-out unknown
    paragraphs stay below, half of them wrapped; 0 if that is at most
    ``LEAST_PROBABILITY``. ``ordinary`` has them counted by their pairs
    (terms, n) or as they are (id, line)."""
    spark = ordinary.sparkSession
    pairs = [r["pair"] for r in classifier.weights.select("pair").collect()]  # of the notices
    if "terms" not in ordinary.columns:
        ordinary = count_sets(ordinary, _half_wrapped("line", F.col("id")), pairs, [])
    texts = [(f"h{i}", t) for i, t in enumerate(OTHER_HELD_OUT)] + [(f"w{i}", _wrapped(t)) for i, t in enumerate(OTHER_HELD_OUT)]
    others = count_sets(spark.createDataFrame(texts, "id string, line string"), F.col("line"), pairs, [])
    held = ordinary.select("terms", "n").unionByName(others.select("terms", "n"))
    sets = materialize(held.groupBy(F.filter("terms", lambda p: p.isin(pairs)).alias("terms")).agg(F.sum("n").alias("n"))
                       .withColumn("id", F.monotonically_increasing_id()), "license-held-out")
    n = sets.agg(F.sum("n")).first()[0] or 1
    hits = sets.select("id", "n", F.explode("terms").alias("pair")).join(F.broadcast(classifier.weights), "pair")
    best = F.array_max(F.transform("probabilities", lambda p: p["p"]))
    scored = _probabilities(hits, classifier, ["id", "n"]).select(best.alias("p"), "n")
    allowed, above = int(FALSE_ALARMS * n), 0
    highest = scored.filter(F.col("p") > LEAST_PROBABILITY).groupBy("p").agg(F.sum("n").alias("n"))
    for r in highest.orderBy(F.col("p").desc()).limit(allowed + 1).collect():
        above += r["n"]
        if above > allowed:
            return r["p"]
    return 0.0


def _probabilities(hits: DataFrame, c: Classifier, keys: list[str]) -> DataFrame:
    """``keys`` and ``probabilities``, an array of (p, family), of the pairs
    (pair, w) of each key: the probability of each family, given that it is
    this one or unknown."""
    grouped = hits.groupBy(*keys).agg(F.collect_set(F.struct("pair", "w")).alias("hits"))

    def weight_of(k: int):
        return lambda total, hit: total + hit["w"][k]

    # Each family against unknown, whose score is 0: notices that stand side by side are all named.
    named = [F.struct((1 / (1 + F.exp(-F.aggregate("hits", F.lit(b), weight_of(k))))).alias("p"), F.lit(f).alias("family"))
             for k, (f, b) in enumerate(zip(c.families, c.intercepts))]
    return grouped.select(*keys, F.array(*named).alias("probabilities"))


def _anchored(text: Column, c: Classifier) -> Column:
    lowered = F.lower(text)
    found = F.lit(False)
    for word in c.anchors:
        found = found | F.contains(lowered, F.lit(word))
    return found | lowered.rlike("|".join(c.anchor_patterns)) if c.anchor_patterns else found


def scan(docs: DataFrame, c: Classifier) -> DataFrame:
    """(doc_id, text_key, paragraph, family, probability, template, overlap):
    a row per family and place; ``paragraph`` is the number of the line on which
    the window begins, ``text_key`` is ``xxhash64(text)``."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.monotonically_increasing_id().alias("row"))
    row = ["row", "doc_id", "text_key"]
    pairs = word_pairs(keyed.filter(_anchored(F.col("text"), c)), "text", *row)
    hits = materialize(pairs.join(F.broadcast(c.weights.select("pair")), "pair"), "license-hits")

    # Windows that begin at a pair of a notice and hold enough of it, the best of each line.
    ahead = Window.partitionBy("row", "template").orderBy(F.col("pos") / F.col("width")).rangeBetween(0, 1)
    held = hits.join(F.broadcast(c.notices), "pair").withColumns({
        "held": F.size(F.collect_set("pair").over(ahead)),
        "held_own": F.size(F.collect_set(F.when(F.col("own"), F.col("pair"))).over(ahead))})
    enough = (F.col("held") >= LEAST_OVERLAP * F.col("n_pairs")) & (F.col("n_own") > 0) \
        & (F.col("held_own") >= LEAST_OVERLAP * F.col("n_own"))
    windows = held.filter(enough).groupBy(*row, "line", "family", "template", "width").agg(
        F.max(F.struct((F.col("held") / F.col("n_pairs")).alias("overlap"), (-F.col("pos")).alias("back"))).alias("b"))
    best = F.row_number().over(Window.partitionBy("row", "line", "family").orderBy(F.desc("b.overlap"), "template"))
    windows = windows.withColumn("nth", best).filter("nth = 1").select(
        *row, "line", "family", "template", "width", F.col("b.overlap").alias("overlap"), (-F.col("b.back")).alias("start"))
    windows = materialize(windows, "license-windows")

    # All known pairs of each window decide what the classifier names it.
    first = F.col("start") - CONTEXT
    blocks = F.sequence(F.floor(first / BLOCK), F.floor((F.col("start") + F.col("width")) / BLOCK))
    places = windows.select("row", "family", "start", "width", F.explode(blocks).alias("block"))
    inside = hits.select("row", "pos", "pair", F.floor(F.col("pos") / BLOCK).alias("block")).join(places, ["row", "block"]) \
        .filter(F.col("pos").between(first, F.col("start") + F.col("width")))
    named = _probabilities(inside.join(F.broadcast(c.weights), "pair"), c, ["row", "family", "start"])
    own = F.filter("probabilities", lambda p: p["family"] == F.col("family"))
    named = named.select("row", "family", "start", F.get(own, F.lit(0)).alias("top")).filter(F.col("top.p") > c.threshold)
    found = windows.join(named, ["row", "family", "start"]).withColumn("before", F.lag("start").over(
        Window.partitionBy("row", "family").orderBy("start")))
    found = found.filter(F.col("before").isNull() | (F.col("start") - F.col("before") > F.col("width")))
    return found.select("doc_id", "text_key", F.col("line").alias("paragraph"), "family", F.col("top.p").alias("probability"),
                        "template", "overlap").dropDuplicates(["doc_id", "text_key", "paragraph", "family"])


def document_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_licensed, families, probability) per document:
    the families of its licence paragraphs, sorted and joined by commas, and
    the lowest of their probabilities."""
    found = materialize(scan(docs, train(docs)), "license-paragraphs")
    per_text = found.groupBy(F.col("doc_id").alias("f_doc_id"), F.col("text_key").alias("f_text_key")).agg(
        F.count_distinct("paragraph").alias("n_licensed"), F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"),
        F.min("probability").alias("probability"))
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"),
        F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0).cast("long").alias("n_paragraphs"))
    joined = rows.join(per_text, F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("text_key") == F.col("f_text_key")), "left")
    return joined.select("doc_id", "n_paragraphs", F.coalesce("n_licensed", F.lit(0)).alias("n_licensed"),
                         F.coalesce("families", F.lit("")).alias("families"), "probability")
