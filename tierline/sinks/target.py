"""A keyed target on plain parquet, written with Spark's own writer.

The target is one parquet folder, partitioned by a hash bucket of its key. A
merge reads the buckets that its staged rows touch, and replaces exactly these
by dynamic partition overwrite; the other buckets are neither read nor written.
The number of buckets grows with the target (about ``ROWS_PER_BUCKET`` rows in
each, so a bucket is one task and one file of bounded size); when it does, or
when the merge brings new columns, the whole target is rewritten once.

A folder cannot be overwritten while it is read, and a job that dies between
removing old files and moving new ones in would lose rows. So the merged rows
are written to ``<root>-pending`` first, whole, and the target is overwritten
from there; then the pending folder is emptied. A run that died in between is
completed by the next one (:func:`complete_pending`): the pending rows are the
final rows of their buckets, so writing them again changes nothing.

One writer at a time, as for any parquet folder. Readers that list the folder
while a merge moves files see old and new buckets side by side, each whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = "_buckets"
BUCKET = "_bucket"
LAYOUT = (BUCKETS, BUCKET)
ROWS_PER_BUCKET = 1_000_000
# The target is dealt anew when its buckets hold more than so many times that.
GROWTH = 4
# Above so many touched buckets the whole target is merged without naming them.
MAX_NAMED = 10_000
WHOLE = "_whole"


def _open(spark: SparkSession, root: str) -> DataFrame | None:
    """The folder with its layout columns; None if nothing was written."""
    try:
        df = spark.read.parquet(root)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df


def target_exists(spark: SparkSession, root: str) -> bool:
    return _open(spark, root) is not None


def read_target(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """The current rows; an empty frame of ``schema`` when none were written."""
    df = _open(spark, root)
    if df is not None:
        return df.drop(*LAYOUT)
    if schema is None:
        raise FileNotFoundError(f"nothing written under {root}")
    return spark.createDataFrame([], schema)


def register_target_view(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Expose the target as a temporary view, so that SQL (e.g. the dashboard
    queries a serving database would take) runs on it in Spark."""
    current = read_target(spark, root, schema)
    current.createOrReplaceTempView(name)
    return current


def buckets_for(rows: int) -> int:
    """The smallest power of two with at most ``ROWS_PER_BUCKET`` rows a bucket."""
    n = 1
    while n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _layout(df: DataFrame) -> int:
    """The number of buckets of a written target, from its file names."""
    name = next((part for f in df.inputFiles() for part in f.split("/") if part.startswith(f"{BUCKETS}=")), None)
    return int(name.partition("=")[2]) if name else 0


def _profile(staged: DataFrame, key: str, buckets: int, what: str) -> tuple[int, list[int] | None]:
    """``(rows, touched buckets)`` in one job; null or repeated keys are refused.
    The buckets are None where there are too many to name."""
    named = F.slice(F.collect_set(_bucket(key, buckets)), 1, MAX_NAMED + 1) if buckets <= MAX_NAMED else F.lit(None)
    row = staged.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("rows"), F.max("n").alias("widest"), F.count_if(F.col(key).isNull()).alias("nulls"),
        named.alias("touched")).first()
    if row["nulls"]:
        raise ValueError(f"null key in {what}")
    if (row["widest"] or 0) > 1:
        raise ValueError(f"duplicate key in {what}: {row['widest']} rows share one {key}")
    return int(row["rows"] or 0), row["touched"]


def merge_target(
    staged: DataFrame,
    root: str,
    key: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    schema: StructType,
) -> None:
    """Replace the target's rows by ``merge(target, staged)``, rewriting only
    the buckets that ``staged`` touches; ``merge`` gets the current rows of
    these buckets (of ``schema`` where there are none yet) and returns their
    new rows. ``staged`` is read several times: materialize it first."""
    spark = staged.sparkSession
    complete_pending(spark, root)
    current = _open(spark, root)
    buckets = _layout(current) if current is not None else 0
    rows, touched = _profile(staged, key, max(buckets, 1), "staged rows")
    if not rows:
        return
    held = current.count() if current is not None else 0  # from the footers
    grown = buckets == 0 or held + rows > GROWTH * buckets * ROWS_PER_BUCKET
    if grown:
        merged = merge(spark.createDataFrame([], schema) if current is None else current.drop(*LAYOUT), staged)
        buckets = buckets_for(held + rows)
        _write(merged, root, key, buckets, True, buckets)
        return
    here = current if touched is None else current.filter(F.col(BUCKET).isin(touched))
    merged = merge(here.drop(*LAYOUT), staged)
    new_columns = set(merged.columns) != set(current.columns).difference(LAYOUT)
    if new_columns:
        merged = merge(current.drop(*LAYOUT), staged)
    _write(merged, root, key, buckets, new_columns, buckets if new_columns or touched is None else len(touched))


def replace_target(df: DataFrame, root: str, key: str) -> None:
    """Write ``df`` as the whole target. It must not read the target itself."""
    rows, _ = _profile(df, key, 1, "target")
    _write(df, root, key, buckets_for(rows), True, buckets_for(rows))


def _write(df: DataFrame, root: str, key: str, buckets: int, whole: bool, touched: int | None = None) -> None:
    rows = df.withColumns({BUCKETS: F.lit(buckets), BUCKET: _bucket(key, buckets), WHOLE: F.lit(whole)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(WHOLE, BUCKETS).parquet(_pending(root))
    complete_pending(df.sparkSession, root, touched)


def _pending(root: str) -> str:
    return f"{root.rstrip('/')}-pending"


def complete_pending(spark: SparkSession, root: str, touched: int | None = None) -> bool:
    """Bring the rows that wait beside the target into it; whether there were
    any. ``touched`` is the number of buckets they belong to, counted if None."""
    pending = _open(spark, _pending(root))
    if pending is None:
        return False
    whole = any(f"/{WHOLE}=true/" in f for f in pending.inputFiles())
    if touched is None:
        touched = pending.agg(F.count_distinct(BUCKET)).first()[0]
    # As many tasks as buckets, each written whole by one of them.
    dealt = pending.drop(WHOLE).repartition(max(int(touched), 1), BUCKET)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic") \
        .partitionBy(*LAYOUT).parquet(root)
    # An overwrite by no rows leaves no partition, which reads as no pending rows.
    spark.createDataFrame([], pending.schema).write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .partitionBy(WHOLE, BUCKETS).parquet(_pending(root))
    return True
