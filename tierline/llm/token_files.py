"""Token ids in bit-plane shuffled files.

Texts are encoded with a tokenizer file of the ``tokenizers`` library, an end
id is appended to each document, and the ids are written in ascending doc_id
order. A *shard* is the output of one task of a range partitioning by doc_id;
it holds *chunks* of whole documents. In a chunk, every block of 65,536 ids is
transposed into planes (byte planes: all first bytes, all second bytes, ...;
bit planes: all lowest bits, ...), and each plane of each block is compressed
on its own with zstandard. Planes of zeros take no bytes.

Layout under a path:

- ``chunks/``: Parquet rows (shard, chunk, start, n_ids, doc_ids, n_tokens,
  payload). Spark's committer writes them, so a retried task leaves no debris,
  and any file system that Spark writes works. ``payload`` is self-describing:
  the magic ``BPS1``, then little-endian plane mode (u8), block length (u32),
  ids (u64), number of planes (u32), their compressed lengths (u32 each), and
  the compressed planes, block by block.
- ``index/``: the chunk index, one row per chunk (shard, chunk, first id
  position of the corpus, number of ids and documents, first and last doc_id,
  payload bytes) for random access.

Defined results: a null or empty text is the end id alone; a null doc_id sorts
first; rows that repeat a doc_id are ordered by text; an empty table gives no
chunks; other columns are ignored. Texts are encoded whole.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches

MAGIC = b"BPS1"
BYTE_PLANES, BIT_PLANES = 0, 1
BLOCK_IDS = 65_536
CHUNK_IDS = 4 * BLOCK_IDS
ZSTD_LEVEL = 3
# Distinct words whose ids a task remembers (about 100 MB at most).
CACHE_WORDS = 400_000

CHUNK_COLUMNS = ["shard", "chunk", "start", "n_ids", "doc_ids", "n_tokens", "payload"]
CHUNK_SCHEMA = ("shard int, chunk int, start long, n_ids long, doc_ids array<long>, "
                "n_tokens array<long>, payload binary")


# ---------------------------------------------------------------- encoding

# White space other than a space or line break: texts with it go whole.
_OTHER_GAPS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"] + ["\u180e", "\u200b", "\ufeff"]
_DOUBLE_GAPS = ("  ", "\n\n", " \n", "\n ")
_TAILS = ".,;:!?%$&*#|"
# Letters up to here are letters in every version of Unicode.
_LAST_LETTER = "\u024f"


class WordEncoder:
    """Encodes texts with a tokenizer whose words are independent of each other.

    Byte-level BPE never merges across a single space or line break between
    two other characters, nor between letters and the marks after them, so the
    ids of a text are the ids of its words in a row. Each distinct word goes
    through the library once and is remembered. Texts with other white space,
    or with a special token in them, go through the library whole; so does
    everything if a probe shows that the tokenizer works differently.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.line_break = self._whole("\n")
        self.by_word = len(self.line_break) == 4 and self._splits_at_words()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def _splits_at_words(self) -> bool:
        """Whether this tokenizer treats words as independent (a probe)."""
        probe = "Ab cd, éfg.\nEf 12 g.h ijk!!\nLmñ op"
        try:
            return self._by_word([probe]) == [self._whole(probe)]
        except ValueError:  # a byte-level letter that the model does not know
            return False

    def _plain(self, text: str) -> bool:
        """Only single spaces and line breaks, none at the ends."""
        return (not text[0].isspace() and not text[-1].isspace()
                and not any(g in text for g in _DOUBLE_GAPS) and not any(g in text for g in _OTHER_GAPS)
                and not any(t in text for t in self.specials))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plain = [i for i, t in enumerate(texts) if self.by_word and t and self._plain(t)]
        out = [b""] * len(texts)
        for i, ids in zip(plain, self._by_word([texts[i] for i in plain])):
            out[i] = ids
        for i in set(range(len(texts))).difference(plain):
            out[i] = self._whole(texts[i]) if texts[i] else b""
        return out

    def forget(self) -> None:
        """Drop the words remembered so far."""
        self.cache.clear()
        self.tails.clear()

    def _by_word(self, texts: list[str]) -> list[bytes]:
        pieces: list[str] = []
        ends: list[int] = []
        for text in texts:
            # A leading line break gives the first word the same form as the
            # first word of a line; its id is cut off again.
            pieces += f"\n{text}".replace("\n", " \n").split(" ")[1:]
            ends.append(len(pieces))
        found = list(map(self.cache.get, pieces))
        if None in found:
            missing = [k for k, ids in enumerate(found) if ids is None]
            self._learn(list(dict.fromkeys(pieces[k] for k in missing)))
            for k in missing:
                found[k] = self.cache[pieces[k]]
        out, begin = [], 0
        for end in ends:
            out.append(b"".join(found[begin:end])[4:])
            begin = end
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        return out

    def _learn(self, words: list[str]) -> None:
        """Put new words into the cache. Words of letters, with or without
        marks after them, go straight to the library's model; the others are
        encoded in one text, one per line, and cut at the line breaks."""
        model, cache, rest = self.tokenizer.model, self.cache, []
        for word in words:
            stem = word.rstrip(_TAILS)
            letters = stem[1:] if word[0] == "\n" else stem
            if not letters.isalpha() or max(letters) > _LAST_LETTER:
                rest.append(word)
                continue
            ids = cache.get(stem)
            if ids is None:
                form = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_LETTERS)
                line = word[0] == "\n"
                ids = array("I", [t.id for t in model.tokenize(form if line else _SPACE_LETTER + form)]).tobytes()
                cache[stem] = ids = self.line_break + ids if line else ids
            if len(stem) < len(word):
                tail = word[len(stem):]
                if tail not in self.tails:
                    self.tails[tail] = self._whole(tail)
                cache[word] = ids + self.tails[tail]
        if not rest:
            return
        raw = self._whole("".join(w if w[0] == "\n" else f"\n {w}" for w in rest))
        at = np.flatnonzero(np.frombuffer(raw, dtype="<u4") == int.from_bytes(self.line_break, "little")) * 4
        begins, ends = at.tolist(), [*at[1:].tolist(), len(raw)]
        for word, b, e in zip(rest, begins, ends, strict=True):
            cache[word] = raw[b:e] if word[0] == "\n" else raw[b + 4:e]


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1
    stays, the other bytes follow from U+0100 on, in order."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) if b in kept else chr(256 + others.index(b)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()
_SPACE_LETTER = _BYTE_LETTERS[32]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer_file: str) -> WordEncoder:
    """One encoder per Python worker and file; tasks forget their words."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


# ------------------------------------------------------------------ planes

def pack_ids(ids: np.ndarray, mode: int = BYTE_PLANES, block_ids: int = BLOCK_IDS) -> bytes:
    """Shuffle ids (u32) block by block into planes and compress each plane."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress
    frames = []
    for at in range(0, len(ids), block_ids):
        raw = np.ascontiguousarray(ids[at:at + block_ids], dtype="<u4").view(np.uint8).reshape(-1, 4)
        planes = raw.T if mode == BYTE_PLANES else \
            np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)
        frames += [compress(p.tobytes()) if p.any() else b"" for p in planes]
    head = MAGIC + struct.pack("<BIQI", mode, block_ids, len(ids), len(frames))
    return head + np.array([len(f) for f in frames], dtype="<u4").tobytes() + b"".join(frames)


def unpack_ids(payload: bytes) -> np.ndarray:
    """The inverse of :func:`pack_ids`."""
    import zstandard

    if payload[:4] != MAGIC:
        raise ValueError("not a bit-plane payload")
    decompress = zstandard.ZstdDecompressor().decompress
    mode, block_ids, n_ids, n_frames = struct.unpack_from("<BIQI", payload, 4)
    at = 4 + struct.calcsize("<BIQI")
    lengths = np.frombuffer(payload, dtype="<u4", count=n_frames, offset=at)
    at += 4 * n_frames
    ids = np.empty(n_ids, dtype="<u4")
    per_block = 4 if mode == BYTE_PLANES else 32
    for b in range(0, n_frames, per_block):
        begin = b // per_block * block_ids
        size = min(block_ids, n_ids - begin)
        width = size if mode == BYTE_PLANES else (size + 7) // 8
        planes = np.zeros((per_block, width), dtype=np.uint8)
        for p in range(per_block):
            if n := int(lengths[b + p]):
                planes[p] = np.frombuffer(decompress(payload[at:at + n]), dtype=np.uint8)
                at += n
        raw = planes.T if mode == BYTE_PLANES else \
            np.packbits(np.unpackbits(planes, axis=1, count=size).T, axis=1, bitorder="little")
        ids[begin:begin + size] = np.ascontiguousarray(raw).reshape(-1).view("<u4")
    return ids


# ---------------------------------------------------------- writing, reading

def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, mode: int = BYTE_PLANES) -> None:
    """Encode ``docs`` (doc_id, text) and write chunks and index under ``path``."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, end = encoder(tokenizer_file), struct.pack("<I", end_id)
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal chunk, start, n_held
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            row = [[shard], [chunk], [start], [len(ids)], [doc_ids[:]], [[len(h) // 4 for h in held]],
                   [pack_ids(ids, mode)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary()]
            chunk, start, n_held = chunk + 1, start + len(ids), 0
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=CHUNK_COLUMNS)

        try:
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist())):
                    doc_ids.append(doc_id)
                    held.append(ids + end)
                    n_held += len(ids) // 4 + 1
                    if n_held >= CHUNK_IDS:
                        yield flush()
            if held:
                yield flush()
        finally:
            enc.forget()  # else the worker holds them through all later steps

    ordered.mapInArrow(chunks, CHUNK_SCHEMA).write.option("compression", "zstd").parquet(f"{path}/chunks")
    index = _chunks(spark, path).select(
        "shard", "chunk", (F.col("base") + F.col("start")).alias("start"), "n_ids", F.size("doc_ids").alias("n_docs"),
        F.element_at("doc_ids", 1).alias("first_doc"), F.element_at("doc_ids", -1).alias("last_doc"),
        F.octet_length("payload").alias("payload_bytes"))
    index.write.parquet(f"{path}/index")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks with ``base``, the ids of all shards before theirs. There is
    one shard per write task, so the table of shards is small by construction."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks")
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bases = shards.select("shard", (F.sum("n").over(before) - F.col("n")).alias("base"))
    return chunks.join(F.broadcast(bases), "shard")


def _read(spark: SparkSession, path: str, column: str, kind: str, arrow: pa.DataType, value) -> DataFrame:
    """(doc_id, start, n_tokens, column) with ``value(ids as bytes)`` per document."""
    rows = _chunks(spark, path).select("doc_ids", "n_tokens", "payload", (F.col("base") + F.col("start")).alias("start"))
    names = ["doc_id", "start", "n_tokens", column]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                doc_ids, counts, payload, start = (batch.column(c)[r].as_py() for c in range(4))
                ids = unpack_ids(payload)
                ends = np.cumsum(np.array(counts, dtype=np.int64))
                begins = ends - counts
                values = [value(ids[b:e].tobytes()) for b, e in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(begins + start, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(values, arrow)], names=names)

    small_batches(spark)
    return rows.mapInArrow(decode, f"doc_id long, start long, n_tokens long, {column} {kind}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the ids as little-endian u32 bytes."""
    return _read(spark, path, "ids", "binary", pa.binary(), lambda ids: ids)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    return _read(spark, path, "ids_crc32", "long", pa.int64(), zlib.crc32)
