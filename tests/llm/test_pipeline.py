"""The pipeline against a plain Python version of its stages."""

import math
import re
import zlib
from hashlib import md5

import public_tokenizers
from test_contamination import brute_force as brute_leaks
from test_mixing import reshare
from test_near_dups import brute_force as brute_groups
from tokenizers import Tokenizer

import corpus_pipeline
from tierline.llm import contamination, language_id, mixing
from tierline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_mix(docs, labels):
    """Copies per doc_id for (doc_id, text, source) rows with distinct ids."""
    size = {d: len(WORD.findall(t or "")) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    total = {}
    for d in size:
        total[source[d]] = total.get(source[d], 0) + size[d]
    copies = {}
    for name, target in reshare(total).items():
        members = [d for d in size if source[d] == name]

        def key(d):
            u = (int(md5(f"mix:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / {1: 4, 0: 1, None: 2}[labels.get(d)], d

        members.sort(key=key)
        epochs = int(target // total[name]) if total[name] else 0
        rest = target - epochs * total[name]
        taken, at = set(), 0
        for d in members:
            at += size[d]
            if at <= rest:
                taken.add(d)
        gap = rest - sum(size[d] for d in taken)
        left = [(abs(gap - size[d]), *key(d)) for d in members if d not in taken and abs(gap - size[d]) < gap]
        if left:
            taken.add(min(left)[2])
        for d in members:
            copies[d] = epochs + (d in taken)
    return copies


def test_mixing_equals_the_plain_version(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    want = brute_mix(docs, labels)
    size = {d: len(WORD.findall(t)) for d, t, _ in docs}
    got = {r.doc_id: r.taken for r in QUERIES["op6_mix_sources"](spark, sf).collect()}
    assert got == {d: n * size[d] for d, n in want.items()}
    assert mixing.MAX_EPOCHS == 3


def test_pipeline_equals_the_plain_version(spark, sf, documents):
    got = corpus_pipeline.run(spark, sf).collect()

    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    kept = [r for r in rows if language_id.has_letter(r[1])]
    assert corpus_pipeline.identify_language(spark, documents, sf).count() == len(kept)  # clean documents stay
    groups = brute_groups([(d, t) for d, t, _ in kept], 5, 80, 100)
    kept = [r for r in kept if groups[r[0]][1] == r[0]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {h for _, t in items for h in contamination.words_of(t).tolist()}
    suspects = [(d, t) for d, t, _ in kept if sum(h in grams for h in contamination.words_of(t).tolist()) >= 10]
    leaks = {d for d, _ in brute_leaks(suspects, items)}
    kept = [r for r in kept if r[0] not in leaks]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    copies = brute_mix(kept, labels)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want, at = [], 0
    for doc_id, text, _ in sorted(kept):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, corpus_pipeline.END_ID]
        for _ in range(copies[doc_id]):
            want.append((doc_id, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            at += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want


def test_stages_keep_the_columns(spark, edge_docs, no_docs, sf):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf).columns == docs.columns
    clashing = edge_docs.selectExpr("*", "'x' as lid_lang", "1 as lid_score", "'y' as dup_node")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        clashing_out = stage(spark, clashing, sf)
        assert clashing_out.columns == clashing.columns and clashing_out.filter("lid_lang <> 'x'").count() == 0
    texts = {r.text for r in corpus_pipeline.identify_language(spark, edge_docs, sf).collect()}
    assert None not in texts and "" not in texts and "12 34 !!" not in texts
    assert corpus_pipeline.write_token_files(spark, edge_docs, sf).count() == 12
    assert corpus_pipeline.write_token_files(spark, no_docs, sf).count() == 0
