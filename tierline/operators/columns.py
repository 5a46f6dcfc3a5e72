"""Column-level operators: stamps, lenient parsing, drops, bounded text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import lenient_timestamp, now


def stamp(df: DataFrame, name: str = "ingested_at") -> DataFrame:
    """Add the arrival time. In a stream every micro-batch gets its own value."""
    return df.withColumn(name, now())


def parse_timestamp(
    df: DataFrame,
    source: str = "timestamp",
    target: str = "event_timestamp",
    keep_raw: bool = False,
) -> DataFrame:
    """Parse ``source`` text into ``target`` (null when unparsable) and drop the
    raw text unless ``keep_raw``."""
    out = df.withColumn(target, lenient_timestamp(source))
    return out if keep_raw or source == target else out.drop(source)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*names)


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows where a text column exceeds its bound (e.g. a VARCHAR(n) target)."""
    cond = None
    for name, n in limits.items():
        c = F.length(F.col(name)) > F.lit(n)
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def assert_fits(df: DataFrame, limits: dict[str, int]) -> None:
    """Raise ``ValueError`` if a value would not fit its bounded column."""
    bad = too_long(df, limits).limit(1).collect()
    if bad:
        raise ValueError(f"value longer than allowed {limits}: {bad[0].asDict()}")
