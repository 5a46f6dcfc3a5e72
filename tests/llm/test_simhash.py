from hashlib import sha256

import numpy as np

from tierline.llm import simhash as sh
from tierline.llm.queries import QUERIES


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        edited = sh.edit(text, following)
        a, b, c = sh.fingerprint(text), sh.fingerprint(edited), sh.fingerprint(following)
        out.append((doc_id, len(text), sha256(edited.encode()).hexdigest(), a.hex(), b.hex(),
                    sh.likeness(a, b), sh.likeness(a, c)))
    return out


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_neighbours_equal_a_sorted_walk(spark, documents, edge_docs):
    for docs in (documents, edge_docs.withColumnRenamed("lang", "fingerprint"), edge_docs.limit(1)):
        want = expected([(r.doc_id, r.text) for r in docs.collect()])
        assert by_key(sh.neighbour_fingerprints(docs).collect()) == by_key(want)


def test_edited_texts_stay_nearer_than_the_next(spark, documents):
    rows = sh.neighbour_fingerprints(documents).collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.98


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 2, 128) for _ in range(6)]
    points = []
    for i in range(600):
        p = base[i % 6].copy()
        flips = rng.choice(128, int(rng.integers(0, 9)), replace=False)
        p[flips] ^= 1
        points.append(p)
    rows = [(np.packbits(p).tobytes().hex(),) for p in points]
    df = spark.createDataFrame(rows, "fingerprint string")
    for radius in (0, 3, 5):
        got = {r.fingerprint: r.n_near for r in sh.count_near(df, df.limit(200), radius).collect()}
        bits = np.stack(points)
        want = {rows[i][0]: int(((bits != bits[i]).sum(axis=1) <= radius).sum()) for i in range(200)}
        assert got == want


def test_query_counts_near_documents(spark, sf, documents):
    rows = QUERIES["op10_simhash"](spark, sf).collect()
    assert len(rows) == documents.count()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    for r in rows:
        for n, radius in ((r.n_near, 3), (r.n_near_edits, 11)):
            near = sum((x ^ prints[r.doc_id]).bit_count() <= radius for x in prints.values()) - 1
            assert n == (near if r.doc_id % 100 == 0 else None)


def plain_fingerprint(text):
    """SimHash word by word and bit by bit, from the same term hashes."""
    words, sizes = sh.sized_word_hashes(text)
    terms = [(int(w), min(max(float(n) - 2, 0.5), 8.0)) for w, n in zip(words, sizes)]
    pairs = sh.shingle_hashes(words, 2) if len(words) > 1 else []
    terms += [(int(p), (x[1] + y[1]) / 2) for p, x, y in zip(pairs, terms, terms[1:])]
    bits = ""
    for salt in sh._SALTS:
        votes = [0.0] * 64
        for term, weight in terms:
            hashed = int(sh.mix(np.array([term], dtype=np.uint64) + salt)[0])
            for byte in range(8):
                for bit in range(8):
                    votes[8 * byte + bit] += weight if hashed >> (8 * byte + bit) & 1 else -weight
        bits += "".join("1" if v > 0 else "0" for v in votes)
    return int(bits, 2).to_bytes(16)


def test_fingerprint_equals_the_plain_vote(documents):
    texts = [r.text or "" for r in documents.limit(12).collect()]
    for text in ["", "one", "one two", "a a a b", *(t[:600] for t in texts)]:
        assert sh.fingerprint(text) == plain_fingerprint(text)


def test_no_rows(spark, no_docs):
    assert sh.neighbour_fingerprints(no_docs).count() == 0
    assert sh.fingerprint("") == sh.fingerprint(" \n") == bytes(16)


def test_lightly_edited_copies_are_neighbours(spark, documents):
    texts = [r.text for r in documents.filter("length(text) > 1000").orderBy("doc_id").limit(60).collect()]
    rows = []
    for i, text in enumerate(texts):
        words = text.split(" ")
        words[len(words) // 2] = "exchanged"
        rows += [(i, sh.fingerprint(text).hex()), (1000 + i, sh.fingerprint(" ".join(words)).hex())]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    got = {(r.query_id, r.doc_id): r.distance for r in sh.near_documents(df, df.filter("doc_id < 1000")).collect()}
    bits = {d: int(f, 16) for d, f in rows}
    want = {(q, d): (bits[q] ^ bits[d]).bit_count() for q in range(len(texts)) for d in bits if d != q}
    assert got == {k: v for k, v in want.items() if v <= sh.RADIUS}
    assert sum((i, 1000 + i) in got for i in range(len(texts))) >= 0.9 * len(texts)


def test_search_is_whole_at_wide_radii_and_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2, 128)
    points = np.stack([base.copy() for _ in range(400)])
    for p in points:
        p[rng.choice(128, int(rng.integers(0, 14)), replace=False)] ^= 1
    rows = [(i, np.packbits(p).tobytes().hex()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    for radius, limit in ((11, 500_000), (11, 0), (12, 500_000)):
        monkeypatch.setattr(sh, "BROADCAST_KEYS", limit)
        monkeypatch.setattr(sh, "PART_PAIRS", 50)
        got = {(r.query_id, r.doc_id): r.distance for r in sh.near_documents(df, df.limit(50), radius).collect()}
        d = (points[:50, None] != points[None]).sum(axis=2)
        assert got == {(q, i): d[q, i] for q in range(50) for i in range(400) if q != i and d[q, i] <= radius}


def test_query_returns_neighbours(spark, sf, documents):
    prints = {r.doc_id: int(sh.fingerprint(r.text or "").hex(), 16) for r in documents.collect()}
    got = {(r.query_id, r.doc_id): r.distance for r in QUERIES["op10_simhash_neighbours"](spark, sf).collect()}
    assert got == {(q, d): (x ^ y).bit_count() for q, x in prints.items() if q % 100 == 0
                   for d, y in prints.items() if d != q and (x ^ y).bit_count() <= 11}
