import math
import random
import re
import textwrap

from pyspark.sql import functions as F

from tierline.llm import licenses
from tierline.llm.license_templates import TEMPLATES


def test_finds_notices_and_leaves_ordinary_text(spark, documents, edge_docs):
    classifier = licenses.train(documents)
    texts = [
        (1, "Some words.\nLicensed under the Apache License, Version 2.0.\nMore words."),
        (2, "and so on RELEASED!! UNDER!! THE!! MIT!! LICENSE.!! and so on and on"),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under the GNU Affero General Public License, version 3."),
        (5, "The driver showed the license to the general public in version 2 of the work."),
        (6, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."),
        (7, "license"),
        (8, None),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {(r.doc_id, r.paragraph): r.family for r in licenses.scan(docs, classifier).collect()}
    assert found == {(1, 1): "apache", (2, 0): "mit", (3, 0): "gpl", (4, 0): "agpl", (6, 0): "cc-by-nc", (6, 1): "mit"}
    assert licenses.scan(edge_docs, classifier).count() == 0


def test_every_document_is_reported_once(spark, documents, edge_docs, no_docs):
    rows = licenses.document_licenses(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert ("gpl" in r.families.split(",")) == ("GNU General Public License" in texts[r.doc_id])
        assert r.n_paragraphs == len(texts[r.doc_id].split("\n"))
    assert licenses.document_licenses(edge_docs).count() == 12
    assert licenses.document_licenses(no_docs).count() == 0


def test_main_path_is_native(spark, documents):
    plan = licenses.document_licenses(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval"))


def test_finds_wrapped_notices_and_every_family(spark, documents):
    classifier = licenses.train(documents)
    longest = {f: max(TEMPLATES[f], key=len) for f in ("mit", "bsd", "isc", "mpl", "lgpl", "agpl", "gpl", "apache")}
    texts, want = [], {}
    for i, (family, notice) in enumerate(longest.items()):
        for j, mark in enumerate(("", " * ", "// ", "# ", "REM ")):
            wrapped = [mark + line for line in textwrap.wrap(notice, 60)]
            texts.append((10 * i + j, "\n".join(["Some words of a file", mark.rstrip("REM ").strip(), *wrapped, "", "and more of it."])))
            want[10 * i + j] = {family}
    both = textwrap.wrap(longest["mit"], 76) + textwrap.wrap(longest["isc"], 76)
    texts += [(100, "\n".join(both)), (101, " ".join(both)), (102, None), (103, "\n\nThe old\nhouse of the general\n\npublic")]
    texts += [(104, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
                    "that the following conditions\nare met:\n\n1. Redistributions of source code must retain the above copyright\n")]
    want |= {100: {"mit", "isc"}, 101: {"mit", "isc"}, 104: {"bsd"}}
    got = {}
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), classifier).collect()
    for r in rows:
        got.setdefault(r.doc_id, set()).add(r.family)
    assert got == want
    assert {r.paragraph for r in rows if r.doc_id < 100} == {2}


WRONG = [
    "SPDX-License-Identifier: BSL-1.0",
    "SPDX-License-Identifier: EUPL-1.2",
    "Licensed under the Eclipse Public License, Version 2.0.",
    "The Apache License and the GNU General Public License differ in many ways.",
    "Copyright is a right. All rights reserved? No.",
    "This program is not released under the MIT License.",
    "A new public license of the general store of version 2 was released under the sea.",
]


def test_other_licences_comparisons_and_negations_are_unknown(spark, documents):
    classifier = licenses.train(documents)
    assert licenses.LEAST_PROBABILITY <= classifier.threshold < 1
    texts = [(i, t) for i, t in enumerate(WRONG)] + [(100 + i, licenses._wrapped(t)) for i, t in enumerate(WRONG)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert [tuple(r) for r in licenses.scan(docs, classifier).select("doc_id", "family", "probability").collect()] == []


def test_every_template_is_found_and_named_by_the_classifier(spark, documents):
    classifier = licenses.train(documents)
    texts = [(f, t) for f, notices in TEMPLATES.items() for t in notices]
    docs = spark.createDataFrame([(i, f"Ordinary words before it.\n\n{licenses._wrapped(t) if i % 2 else t}") for i, (_, t) in enumerate(texts)],
                                 "doc_id long, text string")
    found = {}
    for r in licenses.scan(docs, classifier).collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    own = {r.template for r in classifier.notices.filter("n_own > 0").select("template").distinct().collect()}
    missed = [t for i, (f, t) in enumerate(texts) if found.get(i) != {f}]
    assert len(missed) <= 0.1 * len(texts), missed
    assert len(own) >= 0.9 * len(texts)


def plain_scan(texts, c, spark):
    """(doc_id, line, family) of every confirmed and named window."""
    words = {}
    for doc_id, text in texts:
        row = []
        for n, line in enumerate((text or "").split("\n")):
            line = re.sub(r"^[^\w]*(?:rem|dnl)\s", "", line.lower())
            row += [(n, w) for w in re.findall(r"[^\W_]+", line)] or [(n, "")]
        words[doc_id] = row
    spelled = sorted({(a[1], b[1]) for row in words.values() for a, b in zip(row, row[1:]) if a[1] and b[1]})
    frame = spark.createDataFrame(spelled, "a string, b string")
    code = {(r.a, r.b): r.pair for r in frame.withColumn("pair", F.xxhash64("a", "b")).collect()}
    weights = {r.pair: r.w for r in c.weights.collect()}
    notices = {}
    for r in c.notices.collect():
        notices.setdefault(r.template, (r.family, r.width, r.n_pairs, r.n_own, {}))[4][r.pair] = r.own
    found = {}
    for doc_id, row in words.items():
        pairs = [(i, row[i][0], code[row[i][1], row[i + 1][1]]) for i in range(len(row) - 1) if row[i][1] and row[i + 1][1]]
        pairs = [p for p in pairs if p[2] in weights]
        best = {}
        for template, (family, width, n_pairs, n_own, held) in sorted(notices.items()):
            for start, line, pair in pairs:
                if pair not in held or not n_own:
                    continue
                inside = {p for i, _, p in pairs if start <= i <= start + width and p in held}
                own = sum(held[p] for p in inside)
                if len(inside) >= 0.6 * n_pairs and own >= 0.6 * n_own:
                    rank = (-len(inside) / n_pairs, template, start)
                    if (line, family) not in best or rank < best[line, family][0]:
                        best[line, family] = (rank, start, width)
        last = {}
        for (line, family), (_, start, width) in sorted(best.items(), key=lambda x: x[1][1]):
            inside = {p for i, _, p in pairs if start - licenses.CONTEXT <= i <= start + width}
            scores = [b + sum(weights[p][k] for p in inside) for k, b in enumerate(c.intercepts)]
            if 1 / (1 + math.exp(-scores[c.families.index(family)])) > c.threshold:
                if family not in last or start - last[family] > width:
                    found.setdefault(doc_id, set()).add((line, family))
                last[family] = start
    return found


def test_scan_equals_a_plain_version(spark, documents):
    classifier = licenses.train(documents)
    texts = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").limit(120).collect()]
    rng = random.Random(2)
    every = [t for notices in TEMPLATES.values() for t in notices] + WRONG
    for i in range(60):
        parts = [rng.choice(every) for _ in range(rng.randint(1, 3))]
        words = " ".join(parts).split(" ")
        if i % 3 == 0:  # some words lost
            words = [w for w in words if rng.random() > 0.15]
        if i % 2:
            words = [w + ("\n" if rng.random() < 0.15 else "") + ("\n\n# " if rng.random() < 0.02 else "") for w in words]
        texts.append((10_000 + i, " ".join(words)))
    want = plain_scan(texts, classifier, spark)
    got = {}
    for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), classifier).collect():
        got.setdefault(r.doc_id, set()).add((r.paragraph, r.family))
    assert got == want and len(want) > 30


def test_word_pairs_and_lines(spark):
    docs = spark.createDataFrame([(1, "a b\n\nc\n *\n# d\nREM e\ndnl f"), (2, None), (3, "x")], "doc_id long, text string")
    rows = sorted(tuple(r) for r in licenses.word_pairs(docs, "text", "doc_id").collect())
    code = {r.p: r.h for r in spark.createDataFrame([("a b",), ("d e",), ("e f",)], "p string").select(
        "p", F.xxhash64(F.split_part("p", F.lit(" "), F.lit(1)), F.split_part("p", F.lit(" "), F.lit(2))).alias("h")).collect()}
    assert rows == [(1, 0, 0, code["a b"]), (1, 5, 4, code["d e"]), (1, 6, 5, code["e f"])]


def test_threshold_is_the_highest_held_out_paragraph(spark, documents):
    classifier = licenses.train(documents)
    ordinary = spark.createDataFrame([("a", "plain words of a plain text"), ("b", "Text. All rights reserved.")], "id string, line string")
    highest = licenses._highest_unknown(ordinary, classifier)
    assert highest > licenses.LEAST_PROBABILITY  # an unknown paragraph like a notice lifts the threshold
    assert licenses._highest_unknown(ordinary.filter("id = 'a'"), classifier) < highest


def test_clashing_columns(spark, documents):
    rows = licenses.document_licenses(documents.limit(20).selectExpr("*", "'x' as row", "1 as pair", "2 as families", "3 as line"))
    assert rows.count() == 20


def test_every_ordinary_paragraph_counts(spark):
    """More documents and paragraphs than the sample of former times had."""
    rows = [(i, f"plain words {i}\nThe software is furnished to do so {i}" if i % 500 == 7 else f"plain words {i}") for i in range(6000)]
    docs = spark.createDataFrame([*rows, (6000, None), (6001, "All rights reserved.\n\n")], "doc_id long, text string")
    pair = spark.range(1).select(F.xxhash64(F.lit("is"), F.lit("furnished"))).first()[0]
    sets = licenses.count_sets(licenses.ordinary_lines(docs), F.col("line"), [pair], ["software"], "held_out").collect()
    assert sum(r.n for r in sets) == 6012 and len({r.held_out for r in sets}) == 2
    assert sum(r.n for r in sets if r.terms == [pair] and r.named == ["software"]) == 12
    assert sum(r.n for r in sets if r.terms) == 12


def test_threshold_counts_sets_by_their_number(spark, documents):
    classifier = licenses.train(documents)
    line = "Text. All rights reserved."
    one = spark.createDataFrame([("b", line)], "id string, line string")
    highest = licenses._highest_unknown(one, classifier)
    pairs = [r.pair for r in classifier.weights.collect()]
    terms = licenses.count_sets(one, F.col("line"), pairs, []).first().terms
    sets = spark.createDataFrame([(terms, 20), ([], 10_000)], "terms array<long>, n long")
    assert licenses._highest_unknown(sets, classifier) == highest  # 20 of 10,000 are more than one in a thousand
    rare = spark.createDataFrame([(terms, 2), ([], 10_000_000)], "terms array<long>, n long")
    assert licenses._highest_unknown(rare, classifier) == 0.0
