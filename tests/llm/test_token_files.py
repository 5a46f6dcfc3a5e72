import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierline.llm import token_files as tf
from tierline.session import scratch_path

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
ENCODER = tf.WordEncoder(FILE)


def whole(text):
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


ODD = ["", " ", "a", " a", "a ", "a  b", "a\n\nb", "\n", "\na", "a\n b", "a \nb", "don't it's", "a\tb", "12 34\n56.78 9",
       "x <|endoftext|> y", "é 漢字 かな 😀 ok", "a\x1cb c", "a\r\nb", "'s 't", "　x y", "a\u0085b c", "zz​ yy",
       "Ünïcödé wörd. naïve, Straße!! ñ$$$ a||| |a x; y: \nÀb", "ª º µ ſ ǅ", "aβ β αβγ д", "é á.", "a.b. c.,d"]


def test_encoder_equals_the_library(documents):
    texts = ODD + [r.text for r in documents.collect()]
    assert ENCODER.by_word
    assert ENCODER.encode(texts) == [whole(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n .,!?0'\t漢 ñ|", max_size=25), max_size=4))
def test_encoder_equals_the_library_on_random_texts(texts):
    assert ENCODER.encode(texts) == [whole(t) for t in texts]


@pytest.mark.parametrize("mode", [tf.BYTE_PLANES, tf.BIT_PLANES])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, 65_536, 65_537, 140_000])
def test_planes_round_trip(mode, n):
    rng = np.random.default_rng(n)
    for top in (2, 50_257, 2**32):
        ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
        assert np.array_equal(tf.unpack_ids(tf.pack_ids(ids, mode)), ids)


def expected(rows):
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole(text or "") + (2).to_bytes(4, "little")
        out.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


@pytest.mark.parametrize("mode", [tf.BYTE_PLANES, tf.BIT_PLANES])
def test_files_round_trip(spark, documents, edge_docs, mode):
    docs = documents.unionByName(edge_docs).withColumnsRenamed({"lang": "shard", "source": "start"})
    path = scratch_path(spark, "test-tokens")
    tf.write_tokens(docs, path, FILE, 2, mode)
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tf.read_digests(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    ids = {r.start: r.ids for r in tf.read_tokens(spark, path).collect()}
    assert all(zlib.crc32(ids[start]) == crc for _, start, _, crc in want)
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert sum(r.n_ids for r in index) == want[-1][1] + want[-1][2]
    assert sum(r.n_docs for r in index) == len(want)


def test_empty_table(spark, no_docs):
    path = scratch_path(spark, "test-tokens")
    tf.write_tokens(no_docs, path, FILE, 2)
    assert tf.read_digests(spark, path).count() == 0


def test_cache_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(tf, "CACHE_WORDS", 5)
    encoder = tf.WordEncoder(FILE)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "cd.", "Ef", "gh!!", "ij"]) for _ in range(20)) for _ in range(30)]
    assert [encoder.encode([t])[0] for t in texts] == [whole(t) for t in texts]


def test_workers_hold_no_words_and_no_memory_back_after_a_write(spark, documents):
    """What a worker holds after the write adds to the memory of every later step."""
    def held(batches):
        for _ in batches:
            words = sum(len(e.cache) + len(e.tails) for e in tf._ENCODERS.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(tf._ENCODERS)]), pa.array([words]), pa.array([pa.default_memory_pool().backend_name])],
                names=["encoders", "words", "pool"])

    tf.write_tokens(documents, scratch_path(spark, "test-tokens"), FILE, 2)
    rows = spark.range(0, 64, 1, 16).mapInArrow(held, "encoders long, words long, pool string").collect()
    assert any(r.encoders for r in rows)
    assert {r.words for r in rows} == {0}
    assert {r.pool for r in rows} == {"system"}
