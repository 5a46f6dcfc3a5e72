"""Registered queries of the corpus operators, one per operator.

Each reads its whole table and calls its operator with production parameters;
the operator modules keep their own general interfaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tierline.session import scratch_path

from . import (
    contamination, language_id, licenses, mixing, near_dups, oracles, personal_data, secret_scan, sharding, simhash,
    spans, spelling, token_files, warc, word_runs,
)
from .common import WORD_PATTERN, free_name, materialize, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@register("op1_benchmark_leaks")
def op1_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with the place
    and size of the longest agreeing stretch per item."""
    leaks = contamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return leaks.drop("text_key")


@register("op2_licenses")
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence families of every document."""
    return licenses.document_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document, learning from the text and
    label of the documents that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language_id.held_out().alias("held_out"))
    model = language_id.train(docs.filter(~F.col("held_out")))
    return language_id.predict(docs, model, ["doc_id", "held_out"]) \
        .withColumnsRenamed({"lid_lang": "lang_pred", "lid_score": "score"})


TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


@register("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write their ids in ascending doc_id order as
    bit-plane shuffled files, and report every document as read back."""
    import public_tokenizers

    path = scratch_path(spark, "llm-tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_digests(spark, path)


@register("op5_near_duplicates")
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets overlap by 85 % or more."""
    return near_dups.near_duplicates(read_table(spark, sf_dir, "documents"), 3, 85, 100)


@register("op6_mix_sources", oracles.OP6_SQL)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the source weights 5, 2, 1, repeating."""
    docs = read_table(spark, sf_dir, "documents")
    quality = mixing.label_weights(read_table(spark, sf_dir, "labels"))
    plan = mixing.mix_plan(docs, quality)
    rows = plan.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: exact patterns plus tagged spans."""
    return spans.find_spans(read_table(spark, sf_dir, "documents"), personal_data.PersonalData())


@register("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: exact patterns plus tagged spans."""
    return spans.find_spans(read_table(spark, sf_dir, "documents"), secret_scan.Secrets())


@register("op9_extendible_shards", oracles.OP9_SQL)
def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents into shards of at most 64 MiB of text and report,
    from the written files, every document's shard."""
    docs = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "llm-shards")
    sharding.write_shards(docs, path)
    shard = free_name(docs, "shard")
    files = spark.read.schema(StructType(docs.schema.fields).add(shard, StringType())).parquet(path)
    rows = files.select("doc_id", F.col(shard).alias("shard"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    totals = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return rows.join(totals, "shard").select(
        "doc_id", "shard", (F.length("shard") - 1).alias("depth"), "n_bytes", "shard_bytes", "shard_docs",
        (F.col("shard_bytes") > sharding.LIMIT_BYTES).alias("oversized"),
    )


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts. For the documents
    whose id is divisible by 100, ``n_near`` counts the other documents with a
    fingerprint within 3 of 128 bits, ``n_near_edits`` those within 11; null for
    the rest."""
    rows = materialize(simhash.neighbour_fingerprints(read_table(spark, sf_dir, "documents")), "simhash-rows")
    asked = F.col("doc_id") % 100 == 0
    pairs = simhash.near(rows.select("fingerprint"), rows.filter(asked))
    copies = F.when(F.col("distance") <= simhash.COPY_RADIUS, F.col("rows"))
    near = pairs.groupBy(F.col("query").alias("fingerprint")).agg(
        (F.sum(copies) - 1).alias("n_near"), (F.sum("rows") - 1).alias("n_near_edits"))
    found = rows.filter(asked).join(near, "fingerprint")
    rest = rows.filter(~F.coalesce(asked, F.lit(False))) \
        .withColumns({c: F.lit(None).cast("long") for c in ("n_near", "n_near_edits")})
    return found.select(*rest.columns).unionByName(rest)


@register("op10_simhash_neighbours")
def op10_simhash_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours within 11 of 128 bits of the documents whose id is
    divisible by 100, by id, with their distance."""
    rows = materialize(
        simhash.neighbour_fingerprints(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint"), "simhash-rows")
    return simhash.near_documents(rows, rows.filter(F.col("doc_id") % 100 == 0))


# One run in so many loses a letter before words are counted.
TYPO_EVERY = 199


def with_typos(runs: DataFrame) -> DataFrame:
    """The runs of :func:`spelling.letter_runs`, with a letter dropped from
    those whose checksum with the document's id says so."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs.withColumn("h", F.crc32(key.cast("binary")))
    dropped = spelling.drop_letter(F.col("run"), F.col("h") % F.length("run"))
    return hashed.select("doc_id", F.when(F.col("h") % TYPO_EVERY == 0, dropped).otherwise(F.col("run")).alias("run"))


@register("op11_spelling_variants", oracles.OP11_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their more frequent forms."""
    runs = with_typos(spelling.letter_runs(read_table(spark, sf_dir, "documents"), 6))
    return spelling.spelling_groups(spelling.count_words(runs, 6, 5), 5)


@register("op12_warc", oracles.OP12_SQL)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC files and report every record as read back."""
    path = scratch_path(spark, "llm-warc")
    pages = read_table(spark, sf_dir, "pages")
    warc.write_warc(pages.select("page_id", "url", F.col("html").cast("binary").alias("payload")), path)
    return warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page_id").alias("refers_to"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, by the checksum of its id, the
    words from some place on are replaced by repetitions of the first of them.
    Documents without an id stay as they are."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    picked = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))))
    n, g = F.size("words"), F.floor(F.col("h") / 10).cast("long")
    a = (g % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    placed = picked.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    word = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(
        "words", 1 + F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(n > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


@register("op13_repeated_runs")
def op13_repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of words of every document: their number, the longest,
    and digests of all of them and of the text without repetitions."""
    found = word_runs.collapse_runs(with_repeats(read_table(spark, sf_dir, "documents")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.array_max(order))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
