import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import near_dups as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(rows, k, numerator, denominator):
    """(n_shingles, component) per doc_id from all pairs of distinct sets."""
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(k, len(words))
        sets[doc_id] = frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if denominator * both >= numerator * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_copies(seed, groups, members, change):
    """Groups of texts of 40 to 120 words; each member exchanges up to a share
    ``change`` of the words of its base."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(40, 120))]
        for _ in range(members):
            words = base[:]
            for _ in range(rng.randint(0, int(len(base) * change))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,numerator,groups,members,change", [(3, 85, 60, 6, 0.06), (5, 80, 2, 150, 0.12)])
def test_components_equal_brute_force(spark, k, numerator, groups, members, change):
    rows = near_copies(groups * k, groups, members, change)
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, numerator, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, k, numerator, 100)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_open_pairs_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "PAIRS_PER_ROW", 10**9)
    monkeypatch.setattr(nd, "BLOCK_ROWS", 16)
    rows = near_copies(7, 2, 120, 0.1)
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, 3, 85, 100)


def test_whole_table_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = nd.near_duplicates(documents, 3, 85, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_force(rows, 3, 85, 100)


def test_edges(spark, edge_docs, no_docs):
    got = nd.near_duplicates(edge_docs.withColumnRenamed("lang", "digest"), 3, 85, 100).collect()
    assert len(got) == 12
    by_id = {r.doc_id: r for r in got if r.doc_id not in (5, None)}
    assert by_id[1].component_id == by_id[2].component_id == 1 and not by_id[2].kept
    assert [by_id[i].n_shingles for i in (3, 4, 6, 7, 8, 9)] == [0, 0, 0, 1, 2, 1]
    assert all(by_id[i].component_id == i and by_id[i].kept for i in (3, 4, 6, 7, 8, 9))
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert nd.near_duplicates(no_docs).count() == 0
    kept = nd.keep_one(edge_docs.withColumnRenamed("lang", "dup_doc_id"))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 5, 6, 7, 8, 9]
    assert nd.keep_one(no_docs).columns == no_docs.columns


A = "the first of two passages that each have enough words to be told apart"
B = "another passage, about other things, whose words the first does not hold"


def test_texts_that_share_an_id_are_kept_each_for_itself(spark):
    near_a = A.replace("first", "very first of all")
    for rows, want in (
        ([(1, A), (5, A), (5, B), (9, B)], [(1, A), (5, B)]),
        ([(5, A), (5, B), (3, A), (5, B)], [(3, A), (5, B)]),
        ([(5, A), (5, B), (None, A), (None, A)], [(5, A), (5, B), (None, A), (None, A)]),
        ([(5, A + " " + A + " " + B), (5, A + " " + A + " " + B + " x"), (7, near_a)], [(5, None), (7, near_a)]),
    ):
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("dup_node", F.lit("x"))
        kept = nd.keep_one(docs, 2, 80, 100)
        assert kept.columns == docs.columns
        got = [(r.doc_id, r.text) for r in kept.collect()]
        assert len(got) == len(want)
        assert all(any(g[0] == w[0] and w[1] in (None, g[1]) for g in got) for w in want)


def test_repeated_ids_equal_brute_force(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(40), text) for _, text in near_copies(5, 20, 6, 0.06)]
    rows += rng.sample(rows, 15)
    texts = sorted(set(rows))  # (doc_id, text) pairs are the documents, in the order of their ids
    groups = brute_force([(i, t) for i, (_, t) in enumerate(texts)], 3, 85, 100)
    lowest = {}
    for i, (doc_id, _) in enumerate(texts):
        lowest[groups[i][1]] = min(lowest.get(groups[i][1], doc_id), doc_id)
    want = {texts[i]: (n, lowest[c]) for i, (n, c) in groups.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(docs, 3, 85, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == \
        sorted((d, *want[d, t], want[d, t][1] == d) for d, t in rows)
    kept = [(r.doc_id, r.text) for r in nd.keep_one(docs, 3, 85, 100).collect()]
    of_text = {t: c for i, (_, t) in enumerate(texts) for c in [groups[i][1]]}
    assert sorted(of_text[t] for _, t in kept) == sorted({c for _, c in groups.values()})


def test_posterior_bounds_keep_similar_pairs():
    for hashes, batches in ((120, range(20, 121, 20)), (nd.LONG_HASHES, nd.LONG_BATCHES)):
        least = nd.least_matches(0.85, batches)
        rng = np.random.default_rng(hashes)
        agree = rng.random((20_000, hashes)) < 0.85
        for n, m in least:
            assert (agree[:, :n].sum(axis=1) >= m).mean() > 0.9995
        assert (rng.random(hashes) < 0.5).sum() < least[-1][1]


def test_components_of_long_chains(spark):
    rng = random.Random(3)
    n = 400
    links = [(i, i + 1) for i in range(n - 1) if i % 100 != 99] + [(0, 5), (7, 7)]
    rng.shuffle(links)
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    got = nd.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: i // 100 * 100 for i in range(n)} and len(got) == n


def test_long_texts_are_cut_at_gaps(monkeypatch):
    from tierline.llm import word_hashes as wh

    text = " ".join(f"word{i}é" for i in range(2000)) + " " + "y" * 5000 + " end"
    whole = wh.word_hashes(text)
    monkeypatch.setattr(wh, "SLICE_BYTES", 97)
    assert np.array_equal(wh.word_hashes(text), whole) and len(whole) == 2002
