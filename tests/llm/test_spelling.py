import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.llm import spelling as sp
from tierline.llm.queries import QUERIES, op11_spelling_variants, with_typos


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(words, ratio=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def plain_words(docs, least, count):
    words = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= least and n >= count}


def test_groups_equal_a_plain_version(spark):
    base = ["balance", "calendar", "éléphant", "straßenbahn", "aaaaaa", "separate"]
    words = {}
    for i, w in enumerate(base):
        words[w] = 3_000 // (i + 1)
        for j in range(len(w)):
            words[w[:j] + w[j + 1:]] = 7 + j
            words[w[:j] + "x" + w[j:]] = 600 if j == 2 else 5
            words[w[:j] + "ü" + w[j + 1:]] = 120
            words[w[:j] + "xx" + w[j + 1:]] = 24
    want = plain_groups(words)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    for symbols in (None, 1, 2, 16):
        got = {tuple(r) for r in sp.spelling_groups(frame, 5, symbols).collect()}
        assert got == want
    assert len({r for _, _, r, *_ in want}) < len(words) / 3
    assert max(1 for w, f, r, *_ in want if f is not None and f != r) == 1


def test_ties_take_the_smallest_word(spark):
    frame = spark.createDataFrame([("letter", 1), ("better", 50), ("setter", 50), ("fetter", 49)], "word string, n long")
    rows = {r.word: r for r in sp.spelling_groups(frame).collect()}
    assert (rows["letter"].form, rows["letter"].root, rows["letter"].n_near, rows["letter"].form_n) == ("better", "better", 3, 50)
    assert rows["better"].form is None and rows["better"].root == "better"


def test_neighbourhood_is_full(spark):
    row = spark.createDataFrame([("0120",)], "w string").select(sp.neighbourhood(F.col("w"), 3).alias("a")).first()
    word, want = "0120", set()
    for i in range(5):
        for s in ("", "0", "1", "2"):
            want.add(word[:i] + s + word[i:])
            if i < 4:
                want.add(word[:i] + s + word[i + 1:])
    hashes = {r.h for r in spark.createDataFrame([(w,) for w in want], "w string").select(F.xxhash64("w").alias("h")).collect()}
    assert set(row.a) == hashes and len(row.a) == len(hashes)


def test_runs_keep_accents_and_case_rules(spark):
    docs = spark.createDataFrame(
        [(1, "ÉCOLE École naïve-NAIVE x1y œuvre Straße"), (None, None), (2, ""), (3, "a" * 100_000)],
        "doc_id long, text string")
    runs = [tuple(r) for r in sp.letter_runs(docs).collect()]
    assert sorted(r for d, r in runs if d == 1) == sorted(
        ["École", "École", "naïve", "naive", "x", "y", "uvre", "straße"])
    assert [len(r) for d, r in runs if d == 3] == [100_000]
    assert [r.run for r in sp.letter_runs(docs, 6).filter("doc_id = 1").collect()] == ["straße"]


def test_words_with_typos_equal_a_plain_version(spark, documents, edge_docs):
    for docs in (documents, edge_docs.withColumnRenamed("lang", "word").withColumnRenamed("source", "n")):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = {r.word: r.n for r in sp.count_words(with_typos(sp.letter_runs(docs, 6)), 6, 2).collect()}
        assert got == plain_words(rows, 6, 2)


def test_query_equals_a_plain_version(spark, sf, documents):
    words = plain_words([(r.doc_id, r.text) for r in documents.collect()], 6, 5)
    got = {tuple(r) for r in QUERIES["op11_spelling_variants"](spark, sf).collect()}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    assert {(w, n) for w, _, _, n, _, _ in got} == set(words.items())
    assert got == plain_groups(words)
    assert sum(f is not None for _, f, *_ in got) > 10


def test_no_rows(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert op11_spelling_variants(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        sp.spelling_groups(spark.createDataFrame([], "word string, n long"), ratio=1)
