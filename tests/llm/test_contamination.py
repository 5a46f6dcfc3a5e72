from itertools import combinations

import numpy as np

from tierline.llm import contamination as c


def brute_force(docs, items):
    """Best agreeing stretch per (doc_id, item_id) over every diagonal."""
    found = {}
    for doc_id, text in docs:
        words = c.words_of(text)
        for item_id, item in items:
            other = c.words_of(item)
            if len(other) < c.SPAN:
                continue
            best = None
            for diagonal in range(-len(other) + 1, len(words)):
                o = c.overlap(words, other, diagonal)
                if o:
                    key = (o[2], -o[1], -o[0])
                    best = key if best is None else max(best, key)
            if best:
                found[doc_id, item_id] = best
    return found


def test_masks_hit_every_window_with_two_exchanged_words():
    for bad in combinations(range(c.WINDOW), c.WINDOW - c.LEAST_EQUAL):
        assert any(not any(mask[i] == "1" and p + i in bad for i in range(c.SPAN))
                   for mask in c.MASKS for p in range(c.WINDOW - c.SPAN + 1))


def test_matches_brute_force_with_substitutions(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(200)]

    def text(n):
        return list(rng.choice(vocabulary, n))

    items = [(i, " ".join(text(int(rng.integers(5, 60))))) for i in range(25)]
    docs = []
    for d in range(120):
        words = text(int(rng.integers(0, 120)))
        if d % 3 == 0:
            item = items[int(rng.integers(len(items)))][1].split()
            for _ in range(int(rng.integers(0, 5))):
                item[int(rng.integers(len(item)))] = "changed"
            begin = int(rng.integers(0, len(item)))
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = item[begin // 2:]
        docs.append((d, " ".join(words) if d % 2 else "! ".join(words).upper()))
    rows = c.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): (r.equal, -r.length, -r.start) for r in rows}
    assert got == brute_force(docs, items)
    assert len(got) > 15


def test_whole_table_against_brute_force(spark, sf, documents):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()][:60]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = c.contaminated(documents.limit(1000), benchmark).collect()
    got = {(r.doc_id, r.item_id): (r.equal, -r.length, -r.start) for r in rows}
    expected = brute_force(docs, items)
    ids = {d for d, _ in docs}
    assert {k: v for k, v in got.items() if k[0] in ids} == expected


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "the quick brown fox jumps over the lazy dog and runs away"), (None, "too short"),
         (4, "the quick brown fox jumps over the lazy dog and runs away")], "item_id long, text string")
    rows = c.contaminated(edge_docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 3), (1, 4), (2, 3), (2, 4)}
    assert len(rows) == 4 and all(r.equal == 12 for r in rows)
    clash = edge_docs.withColumnsRenamed({"n_chars": "leak_doc_id", "lang": "text_key"})
    kept = c.decontaminate(clash, items)
    assert kept.columns == clash.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 5, 6, 7, 8, 9]
    assert c.contaminated(no_docs, items).count() == 0
    assert c.decontaminate(edge_docs, items.limit(0)).count() == 12


def test_short_masks_hit_every_allowed_exchange():
    for length in range(1, c.WINDOW):
        bad_words = length - c.needed(length)[1]
        for bad in combinations(range(length), bad_words):
            assert any(all(mask[i] == "0" for i in bad) for mask in c.masks_of(length))
        assert all(len(mask) == length for mask in c.masks_of(length))


def test_short_items_with_every_exchange(spark):
    items, docs, want = [], [], set()
    for length in range(1, c.WINDOW):
        words = [f"i{length}w{j}" for j in range(length)]
        items.append((length, " ".join(words)))
        allowed = length - c.needed(length)[1]
        for n in range(allowed + 2):
            for bad in combinations(range(length), n):
                text = ["x" if j in bad else w for j, w in enumerate(words)]
                docs.append((len(docs), " ".join(["before", "it", *text, "after"])))
                if n <= allowed:
                    want.add((docs[-1][0], length))
    rows = c.contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want


def test_typography_and_unspaced_scripts_do_not_hide_a_copy(spark):
    plain = "\"Well\", she said - it's the old captain's house... and nobody has lived there since the great storm"
    typeset = "\u201cWell\u201d,\u00a0she said\u2014it\u2019s the\u202fold captain\u2019s house\u2026and nobody has\u3000lived there\u2013since the great storm"
    chinese = "\u4eba\u6709\u60b2\u6b22\u79bb\u5408\u6708\u6709\u9634\u6674\u5706\u7f3a\u6b64\u4e8b\u53e4\u96be\u5168"
    thai = "\u0e17\u0e35\u0e48\u0e19\u0e35\u0e48\u0e40\u0e1b\u0e47\u0e19\u0e1a\u0e49\u0e32\u0e19"
    items = spark.createDataFrame([(1, plain), (2, chinese), (3, thai)], "item_id long, text string")
    docs = [(1, typeset), (2, "\u524d\u6587\u3002" + chinese[:8] + "\uff0c" + chinese[8:] + "\u3002\u540e\u6587"),
            (3, "\u0e01\u0e02" + thai + "\u0e01"), (4, "\u6708\u6709\u9634\u6674"), (5, "caf\u00e9 \u00e9t\u00e9")]
    rows = c.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 2), (3, 3)}
    assert (c.words_of(plain) == c.words_of(typeset)).all()
    assert len(c.words_of("e\u0301te\u0301 2\u6708ab\u6708 _\ud800x")) == 6
