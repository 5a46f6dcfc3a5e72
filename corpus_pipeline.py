"""A corpus pipeline: five stages, each one operator of ``tierline.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the ``docs`` of the next stage. All but the last
return the columns of ``documents``:

1. language ID drops documents whose language cannot be told;
2. near-dedup keeps one document of each group of near copies (five words,
   similarity 0.8 or more);
3. decontamination drops documents that hold a benchmark passage;
4. mixing repeats and leaves out documents to meet the source weights;
5. token output encodes what is left into bit-plane shuffled files and
   reports every document as read back from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import contamination, language_id, mixing, near_dups, token_files
from tierline.llm.common import free_name, materialize, read_table
from tierline.session import scratch_path

# SQL cannot express trained classifiers or the tokenizer.
ORACLE_SQL = None

# A document is rejected if no language is certain at least to this degree.
LEAST_LANGUAGE_SCORE = 0.3
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a recognized language; texts without a letter go."""
    model = language_id.train(docs)
    lang, score = free_name(docs, "lid_lang"), free_name(docs, "lid_score")
    named = language_id.predict(docs, model, docs.columns, lang, score)
    known = (F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)
    return named.filter(known).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return near_dups.keep_one(docs, shingle_words=5, numerator=80, denominator=100)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    return contamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents to meet the source weights."""
    quality = mixing.label_weights(read_table(spark, sf_dir, "labels"))
    plan = materialize(mixing.mix_plan(docs, quality), "mix-plan")
    return mixing.apply_mix(docs, plan)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the corpus into token files; one row per document read back."""
    import public_tokenizers

    path = scratch_path(spark, "llm-pipeline-tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_digests(spark, path)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
