"""Language identification by hierarchical discrimination.

A linear support vector machine per language family (one against the rest)
predicts the family first; within the family, one-versus-one linear support
vector machines separate the closely related languages. Features are hashed
character trigrams of the whole lower-cased text, letters only, as square
roots of counts scaled to unit length.

Training takes a bounded sample: at most ``SAMPLE_PER_LANGUAGE`` labelled rows
per language (and ``SAMPLE_PER_FAMILY`` per family for the first step), chosen
by a hash of the id. Every machine is trained by its own Spark task; only
weights come to the driver. Margins become probabilities by a logistic curve
fitted to out-of-fold margins.

Defined results: a null text, or one without a letter, gives ``und`` with
score 0; so does every text if there is no labelled row. With one learned
language every text with a letter gets it with score 1. Rows with null labels
or null ids teach nothing; repeated rows are predicted alike; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

# ISO 639-1 codes by language family. A label that is not listed
# is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu se",
    "turkic": "tr az kk ky uz tk tt",
    "indo-aryan": "hi ur bn pa gu mr ne or as si",
    "iranian": "fa ps ku tg",
    "semitic": "ar he mt am",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms jv su tl mg mi",
    "sinitic": "zh yue wuu",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

UNDETERMINED = "und"
DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE = 300
SAMPLE_PER_FAMILY = 400
SVM_C = 10.0
SVM_EPOCHS = 30
FOLDS = 3
# Characters that are turned into features at a time.
SLICE_CHARS = 1_000_000


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return _FAMILY_OF.get(code, language)


# ---------------------------------------------------------------- features

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter (made once per process)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def trigram_counts(text: str) -> np.ndarray:
    """Hashed trigram counts of the letters of a text, words set apart by one
    gap; zeros if there is no letter."""
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    tail = np.zeros(1, dtype=np.uint32)  # begins like after a gap
    seen = False
    for at in range(0, len(text), SLICE_CHARS):
        codes = np.frombuffer(text[at:at + SLICE_CHARS].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = np.where(_letters()[codes], codes, np.uint32(0))
        seen = seen or bool(codes.any())
        codes = np.concatenate([tail, codes])
        keep = np.ones(len(codes), dtype=bool)
        keep[len(tail):] = (codes[len(tail):] != 0) | (codes[len(tail) - 1:-1] != 0)
        codes = codes[keep]
        if len(codes) > 2:
            h = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) ^ codes[2:] * np.uint32(0xC2B2AE3D)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount(h >> np.uint32(20), minlength=DIMENSIONS)
        tail = codes[-2:]
    if seen and not counts.any():
        counts[0] = 1  # a single letter
    return counts if seen else np.zeros(DIMENSIONS, dtype=np.int64)


def features(texts: list[str]) -> np.ndarray:
    """One unit-length row per text; a row of zeros where there is no letter."""
    x = np.sqrt(np.stack([trigram_counts(t) for t in texts])).astype(np.float32)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm == 0, 1, norm)


# ---------------------------------------------------------------- training

def train_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear SVM (hinge loss, y in -1/+1) by dual coordinate descent; the last
    weight is the bias. Classes are weighted to equal total cost."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    cost = SVM_C * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    diagonal = (x * x).sum(axis=1)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1], dtype=np.float64)
    rng = np.random.default_rng(7)
    for _ in range(SVM_EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(y)):
            gradient = y[i] * float(w @ x[i]) - 1.0
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def margins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def fit_logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of P(y = 1) = 1 / (1 + exp(-(a m + b))), by Newton steps with a
    weak prior that keeps separable data finite."""
    a, b = 1.0, 0.0
    target = np.where(y > 0, 1.0, 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-2 * a, (p - target).sum() + 1e-2 * b])
        v = p * (1 - p)
        h = np.array([[(v * margin * margin).sum() + 1e-2, (v * margin).sum()],
                      [(v * margin).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def train_calibrated(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    fold = np.arange(len(y)) % FOLDS
    out = np.zeros(len(y))
    for k in range(FOLDS):
        rest = fold != k
        if len(set(y[rest])) == 2:
            out[~rest] = margins(x[~rest], train_svm(x[rest], y[rest]))
    return train_svm(x, y), *fit_logistic(out, y)


@dataclass
class Model:
    """Families, their languages, and the machines: weights (bias last) with
    the two numbers of the logistic curve."""

    families: dict[str, list[str]]
    family_machines: dict[str, tuple[np.ndarray, float, float]] = field(default_factory=dict)
    pair_machines: dict[tuple[str, str], tuple[np.ndarray, float, float]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of features."""
        names = sorted(self.families)
        if not names:
            return [UNDETERMINED] * len(x), np.zeros(len(x))
        if len(names) > 1:
            p = np.stack([_probability(x, self.family_machines[f]) for f in names], axis=1)
            p /= p.sum(axis=1, keepdims=True)
        else:
            p = np.ones((len(x), 1))
        best = p.argmax(axis=1)
        score = p[np.arange(len(x)), best]
        languages = [""] * len(x)
        for f, name in enumerate(names):
            rows = np.flatnonzero(best == f)
            members = self.families[name]
            if len(rows) == 0:
                continue
            wins = np.zeros((len(rows), len(members)))
            for a, b in combinations(range(len(members)), 2):
                first = _probability(x[rows], self.pair_machines[members[a], members[b]])
                wins[:, a] += first
                wins[:, b] += 1 - first
            inner = wins.argmax(axis=1)
            if len(members) > 1:
                score[rows] *= wins.max(axis=1) / (len(members) - 1)
            for r, k in zip(rows, inner):
                languages[r] = members[k]
        return languages, np.clip(score, 0.0, 1.0)


def _probability(x: np.ndarray, machine: tuple[np.ndarray, float, float]) -> np.ndarray:
    w, a, b = machine
    return 1 / (1 + np.exp(-np.clip(a * margins(x, w) + b, -30, 30)))


def train(labelled: DataFrame) -> Model:
    """Train on the rows (doc_id, text, lang) of ``labelled``."""
    spark = labelled.sparkSession
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    # One row per language comes to the driver.
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    families: dict[str, list[str]] = {}
    for language in sorted(counts):
        families.setdefault(family_of(language), []).append(language)
    model = Model(families)
    if len(counts) < 2:
        return model

    # A hash threshold thins each language to about twice its bound before the
    # exact cut by hash order, so no window sees a whole language.
    draw = F.pmod(F.xxhash64(F.lit("language-id"), "doc_id"), F.lit(1_000_003))
    limit = F.lit(None)
    for language, n in counts.items():
        share = min(1.0, (2 * SAMPLE_PER_LANGUAGE + 50) / n)
        limit = F.when(F.col("lang") == language, F.lit(int(share * 1_000_003))).otherwise(limit)
    by_hash = Window.partitionBy("lang").orderBy("draw", "doc_id")
    sample = (
        usable.select("doc_id", "text", "lang", draw.alias("draw")).filter(F.col("draw") <= limit)
        .withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= SAMPLE_PER_LANGUAGE)
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each sampled row goes to the machines it helps to train."""
        for batch in batches:
            texts, languages, nths = (batch.column(c).to_pylist() for c in range(3))
            rows = []
            for row, language, nth in zip(features(texts), languages, nths):
                if not row.any():
                    continue
                own, packed = family_of(language), row.tobytes()
                share = max(1, SAMPLE_PER_FAMILY // len(families[own]))
                if len(families) > 1 and nth <= share:
                    rows += [("family", name, "", own == name, packed) for name in families]
                for other in families[own]:
                    if other != language:
                        a, b = sorted((language, other))
                        rows.append(("pair", a, b, language == a, packed))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["step", "a", "b", "positive", "x"])

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["x", "positive"], kind="stable").sample(frac=1, random_state=7)
        x = np.stack([np.frombuffer(v, dtype=np.float32) for v in rows["x"]])
        w, a, b = train_calibrated(x, np.where(rows["positive"], 1.0, -1.0))
        return pd.DataFrame({"step": [key[0]], "a": [key[1]], "b": [key[2]], "w": [w.astype(np.float32).tobytes()],
                             "slope": [a], "shift": [b]})

    small_batches(spark)
    machines = (
        sample.select("text", "lang", "nth").mapInArrow(tasks, "step string, a string, b string, positive boolean, x binary")
        .groupBy("step", "a", "b").applyInPandas(fit, "step string, a string, b string, w binary, slope double, shift double")
    )
    for r in machines.collect():  # one row per machine
        machine = (np.frombuffer(r["w"], dtype=np.float32), r["slope"], r["shift"])
        if r["step"] == "family":
            model.family_machines[r["a"]] = machine
        else:
            model.pair_machines[r["a"], r["b"]] = machine
    return model


def predict(docs: DataFrame, model: Model, keep: list[str], lang: str = "lid_lang", score: str = "lid_score") -> DataFrame:
    """The columns ``keep`` of ``docs`` with the predicted language and its
    score in columns ``lang`` and ``score``, names that ``keep`` must not have."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    columns = [F.col(f"`{c}`") for c in keep] + ([] if "text" in keep else [F.col("text")])
    source = docs.select(*columns)
    place = source.columns.index("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:len(keep)])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            for at in range(0, len(texts), 64):
                x = features([t or "" for t in texts[at:at + 64]])
                found = np.flatnonzero(x.any(axis=1))
                if len(found):
                    languages, values = shared.value.predict(x[found])
                    for k, language, value in zip(found.tolist(), languages, values.tolist()):
                        names[at + k], scores[at + k] = language, value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, lang, score])

    small_batches(spark)
    return source.mapInArrow(label, f"{fields}, `{lang}` string, `{score}` double")


def held_out() -> Column:
    """Whether a document is kept out of training: crc32 of its id mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
