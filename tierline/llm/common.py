"""Helpers shared by the corpus operators: tables, scratch tables, text units."""

from __future__ import annotations

import os
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import scratch_path

# A word is a run of anything but the space and the control characters
# TAB, LF, VT, FF, CR (the definition used by the query contracts).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD_PATTERN)

# Rows per Arrow batch handed to Python. Texts can be long, so batches are
# kept short; memory is then bounded by a few hundred whole texts.
ARROW_ROWS = 256
ARROW_BYTES = 16 * 1024 * 1024
# Python workers outlive a query, so what their allocators hold back adds to the
# memory of every later step: one arena, and Arrow's buffers go through malloc too.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Settings for Python steps: bound what one Arrow batch can hold and what
    idle workers hold back (values that the session set itself stay), and let
    workers find this package where it is not installed (a path that does not
    exist on a worker is ignored there)."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs at most the running tasks, and
    later passes do not scan or recompute the texts.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: str | Column) -> Column:
    """Number of words of a text; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def id_bits(doc_id: str, seed: str, digits: int) -> Column:
    """The first ``digits`` hex digits of md5(seed:doc_id) as a number.

    md5 is chosen because other engines have it too; null ids hash as ''.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")
