import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tierline.llm import word_runs as wr
from tierline.llm.queries import QUERIES, op13_repeated_runs


def plain_runs(words, least_words=6, least_exponent=4):
    """All runs of a sequence, straight from the definition."""
    n, best = len(words), {}
    for q in range(1, n // least_exponent + 1):
        t = 0
        while t + q < n:
            if words[t] != words[t + q]:
                t += 1
                continue
            start = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            if t + q - start >= max(least_words, least_exponent * q):
                best.setdefault((start, t + q), q)
    return sorted((s, e, q) for (s, e), q in best.items())


def plain_text(words, runs):
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def sequences(rng, count):
    for i in range(count):
        n, letters = int(rng.integers(0, 90)), int(rng.integers(1, 5))
        seq = rng.integers(0, letters, n)
        if i % 2 and n > 10:  # a periodic stretch with another one in it
            q = int(rng.integers(1, 9))
            a = int(rng.integers(0, n // 2))
            seq[a:] = np.resize(seq[a:a + q], n - a)
            b = int(rng.integers(a, n))
            seq[b:b + 7] = seq[b]
        yield seq


def test_runs_equal_the_definition():
    for seq in sequences(np.random.default_rng(1), 1500):
        got = [tuple(r) for r in wr.runs_of(seq).tolist()]
        assert sorted(got) == plain_runs(seq.tolist()), seq.tolist()


def test_runs_of_long_periods():
    rng = np.random.default_rng(3)
    for q in (1, 2, 3, 63, 64, 65, 127, 200):
        seq = np.concatenate([rng.integers(0, 50, 37), np.resize(rng.integers(0, 50, q), 4 * q + 9), rng.integers(60, 90, 21)])
        assert (tuple(r) for r in wr.runs_of(seq).tolist())
        assert sorted(map(tuple, wr.runs_of(seq).tolist())) == plain_runs(seq.tolist())


def test_filter_keeps_every_run():
    rng = np.random.default_rng(5)
    seqs = list(sequences(rng, 400))
    ids = np.concatenate(seqs)
    doc = np.repeat(np.arange(len(seqs)), [len(s) for s in seqs])
    base = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    got = sorted(map(tuple, wr.document_runs(ids, doc, 6, 4).tolist()))
    want = sorted((s + b, e + b, q) for seq, b in zip(seqs, base) for s, e, q in plain_runs(seq.tolist()))
    assert got == want and len(want) > 100


def test_wavelet_tree_answers_order_statistics():
    rng = np.random.default_rng(8)
    for n in (1, 2, 5, 64, 200):
        values = rng.permutation(n)
        tree = wr.WaveletTree(values)
        lo = rng.integers(0, n, 100)
        hi = lo + 1 + rng.integers(0, n, 100) % (n - lo)
        x = rng.integers(0, n, 100)
        k = rng.integers(0, 1_000_000, 100) % (hi - lo)
        assert tree.smaller(lo, hi, x).tolist() == [(values[a:b] < v).sum() for a, b, v in zip(lo, hi, x)]
        assert tree.smallest(lo, hi, k).tolist() == [sorted(values[a:b])[c] for a, b, c in zip(lo, hi, k)]


def test_edge_rows(spark, edge_docs, no_docs):
    loop = "tick tock " * 30
    extra = spark.createDataFrame(
        [(20, loop, "en", "a", 1), (20, loop, "en", "a", 1), (None, "x " * 6, None, None, None), (21, "y y y y y", "en", "a", 1),
         (22, "a b " * 8 + "end", "en", "a", 1)], edge_docs.schema)
    docs = edge_docs.unionByName(extra).withColumn("runs", edge_docs.doc_id * 0) if False else edge_docs.unionByName(extra)
    docs = docs.withColumnRenamed("source", "runs").withColumnRenamed("lang", "n_words")
    rows = wr.collapse_runs(docs).collect()
    want = []
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = plain_runs(words) if len(words) < 1000 else [(0, 60_000, 1)]
        want.append((r.doc_id, len(words), sorted((s, e - s, q) for s, e, q in runs), plain_text(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert wr.collapse_runs(no_docs).count() == 0
    with pytest.raises(ValueError):
        wr.collapse_runs(docs, least_exponent=3)


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_a_plain_version(spark, sf, documents):
    rows = {r.doc_id: r for r in QUERIES["op13_repeated_runs"](spark, sf).collect()}
    docs = documents.select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    with_runs = 0
    for d in docs:
        words = contract(d.doc_id, d.text)
        ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
        runs = plain_runs([ids[w] for w in words]) if len(words) <= 2000 else \
            sorted(map(tuple, wr.runs_of(np.array([ids[w] for w in words])).tolist()))
        runs.sort(key=lambda r: (r[0], r[2]))
        r = rows[d.doc_id]
        assert r.n_runs == len(runs)
        with_runs += bool(runs)
        best = max(((e - s, -s, -q) for s, e, q in runs), default=None)
        assert (r.length, r.start, r.period) == ((best[0], -best[1], -best[2]) if best else (None, None, None))
        assert r.exponent_milli == (1000 * best[0] // -best[2] if best else None)
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        assert r.runs_sha256 == sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(plain_text(words, runs).encode()).hexdigest()
    assert with_runs > 5


def test_query_on_edge_rows(spark, edge_docs, tmp_path):
    edge_docs.filter("doc_id is null or doc_id <> 8").write.parquet(str(tmp_path / "documents.parquet"))
    rows = op13_repeated_runs(spark, str(tmp_path)).collect()
    assert len(rows) == 11 and all(r.runs_sha256 and r.collapsed_sha256 for r in rows)
