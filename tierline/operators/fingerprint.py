"""Order-insensitive fingerprints of a DataFrame's rows.

``(row count, sum of 64-bit row hashes)`` compares two results as multisets
without a shuffle: each task sums its own rows and only one partial row per
task travels. The sum is taken as a decimal, so it cannot overflow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> tuple[int, int]:
    cols = sorted(columns or df.columns)
    row = df.select(
        F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)").alias("h")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s")).collect()[0]
    return int(row["n"]), int(row["s"] or 0)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same multiset of rows (by fingerprint)."""
    cols = sorted(a.columns)
    return sorted(b.columns) == cols and fingerprint(a, cols) == fingerprint(b, cols)
