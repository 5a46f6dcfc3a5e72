"""File sources: JSON landing folders (stream or batch) and guarded parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..schemas import RAW_EVENT, TICKET
from ..session import file_stream
from .json_elements import LISTING, array_elements


def parse_json_values(texts: DataFrame, schema: StructType, corrupt_column: str | None = None) -> DataFrame:
    """Rows of ``schema`` from the column ``value``, each a line that holds one
    JSON object or one array of objects.

    The text is parsed inside brackets, so anything after the first value
    (a second array, a broken tail) makes the whole text unparsable instead of
    disappearing. An unparsable text gives one row of nulls; with
    ``corrupt_column``, a string field of ``schema``, that row keeps the text.
    Blank texts hold no rows.
    """
    fields = StructType([f for f in schema.fields if f.name != corrupt_column])
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    arrays = F.flatten(F.from_json(wrapped, ArrayType(ArrayType(fields))))
    parsed = (
        texts.select("value", F.coalesce(arrays, F.from_json(wrapped, ArrayType(fields))).alias("rows"))
        .filter((F.trim("value") != "") & (F.coalesce(F.size("rows"), F.lit(1)) != 0))
        .select("value", F.col("rows").isNull().alias("bad"), F.explode_outer("rows").alias("row"))
    )
    text = F.when(F.col("bad"), F.col("value"))
    return parsed.select(*[
        text.alias(f.name) if f.name == corrupt_column else F.col(f"row.`{f.name}`").alias(f.name)
        for f in schema.fields])


def parse_elements(elements: DataFrame, schema: StructType, corrupt_column: str | None = None) -> DataFrame:
    """Rows of ``schema`` from the elements of landing files (value, bad), one
    each. What is no JSON object gives a row of nulls that, with
    ``corrupt_column``, keeps its text."""
    fields = StructType([f for f in schema.fields if f.name != corrupt_column])
    # Inside brackets, so anything after an element's first value makes it unparsable.
    array = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), ArrayType(fields))
    parsed = elements.select("value", "bad", F.when(~F.col("bad"), array).alias("rows"))
    bad = F.col("bad") | F.col("rows").isNull() | (F.size("rows") != 1) | F.get("rows", F.lit(0)).isNull()
    parsed = parsed.select("value", bad.alias("bad"), F.when(~bad, F.get("rows", F.lit(0))).alias("row"))
    return parsed.select(*[
        F.when(F.col("bad"), F.col("value")).alias(f.name) if f.name == corrupt_column
        else F.col(f"row.`{f.name}`").alias(f.name) for f in schema.fields])


def _parsed(reader, path: str, schema: StructType, multi_line: bool, corrupt_column: str | None) -> DataFrame:
    if multi_line:
        files = reader.schema(LISTING).format("binaryFile").load(path)
        return parse_elements(array_elements(files, path), schema, corrupt_column)
    return parse_json_values(reader.format("text").load(path).select("value"), schema, corrupt_column)


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = False,
    max_files_per_trigger: int | None = None,
    corrupt_column: str | None = None,
    options: dict[str, str] | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming JSON reader with a declared schema (schema on read).

    Only declared fields are kept, all as declared; a missing field is null,
    a nested object read as string is its JSON text. With ``multi_line`` a
    file is one JSON object or array, of any size: it is read element by
    element (:mod:`tierline.sources.json_elements`), and one that holds more
    than one value, or none, gives unparsable rows only. Without it every line
    is one value. See :func:`parse_elements` and :func:`parse_json_values` for
    what does not parse.

    ``max_bytes_per_trigger`` admits files by their size instead of their
    number: a micro-batch takes files until the next one would exceed it (one
    at least), so files of uneven size give even micro-batches.

    ``options`` passes further file-source settings, e.g. ``cleanSource`` =
    ``archive`` with ``sourceArchiveDir`` (or ``delete``) so that a landing
    folder that grows for years is not listed in full on every trigger.
    """
    reader = file_stream(spark)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    elif max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return _parsed(reader, path, schema, multi_line, corrupt_column)


def read_json_batch(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Bounded counterpart of :func:`read_json_stream`."""
    return _parsed(spark.read, path, schema, multi_line, corrupt_column)


def landing_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = TICKET,
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
    corrupt_column: str | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A landing folder of files, each one JSON array of tickets. With
    ``corrupt_column`` (which must be a string field of ``schema``) what does
    not parse keeps its text there."""
    return read_json_stream(spark, path, schema, multi_line=True,
                            max_files_per_trigger=max_files_per_trigger,
                            corrupt_column=corrupt_column, options=options,
                            max_bytes_per_trigger=max_bytes_per_trigger)


def event_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_EVENT,
    max_files_per_trigger: int | None = 100,
    multi_line: bool = False,
    options: dict[str, str] | None = None,
    corrupt_column: str | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Raw events, line-delimited JSON, at most 100 files per micro-batch by
    default, or by size with ``max_bytes_per_trigger``."""
    return read_json_stream(spark, path, schema, multi_line=multi_line,
                            max_files_per_trigger=max_files_per_trigger,
                            corrupt_column=corrupt_column, options=options,
                            max_bytes_per_trigger=max_bytes_per_trigger)


def read_parquet_guarded(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
) -> DataFrame:
    """Parquet scan that treats missing folders as empty instead of failing.

    Missing paths are found at definition time (``PATH_NOT_FOUND``) and left
    out; the others are one scan, however many they are. With none left the
    result is an empty frame of ``schema``: "nothing to do" stays a no-op.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    there = [p for p in paths if _exists(spark, p, schema)]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*there)


def _exists(spark: SparkSession, path: str, schema: StructType) -> bool:
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
