"""Key checks: required keys with a rejects output, and key uniqueness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def _missing(keys: tuple[str, ...]) -> Column:
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all non-null. An empty string is not null and
    passes. The filter is pushed into file scans that support it."""
    return df.filter(~_missing(keys))


def key_rejects(df: DataFrame, *keys: str) -> DataFrame:
    """The complement of :func:`require_key`, with a reason column naming the
    first missing key, so that rows in = kept + rejects."""
    reason = None
    for k in keys:
        reason = (F.when(F.col(k).isNull(), F.lit(f"missing {k}")) if reason is None
                  else reason.when(F.col(k).isNull(), F.lit(f"missing {k}")))
    return df.filter(_missing(keys)).withColumn(REASON, reason)


def split_by_key(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejects)``; both are lazy views of the same input."""
    return require_key(df, *keys), key_rejects(df, *keys)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once (partial counts are combined map-side,
    so a hot key costs one shuffled row per map task)."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def assert_unique(df: DataFrame, *keys: str, what: str = "table") -> None:
    """Raise ``ValueError`` when a key repeats; ships at most one row to the driver."""
    dup = duplicate_keys(df, *keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key in {what}: {dup[0].asDict()}")


def assert_no_null_keys(df: DataFrame, *keys: str, what: str = "table") -> None:
    """Raise ``ValueError`` when any key is null."""
    bad = df.filter(_missing(keys)).limit(1).collect()
    if bad:
        raise ValueError(f"null key in {what}: {bad[0].asDict()}")
