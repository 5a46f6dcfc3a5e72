"""JDBC dimension scans and staging writes.

Connection settings are arguments; nothing is read from the environment.
A scan is split into ``num_partitions`` range queries on
``partition_column`` when bounds are given (without them the whole table is
read by one task). Writes cap the number of concurrent connections with
``num_partitions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.columns import assert_fits


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for Spark's ``jdbc`` data source."""
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    elif num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Scan a database table (filters and columns are pushed into the query)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    truncate: bool = False,
    batch_size: int | None = None,
    column_types: str | None = None,
    max_length: dict[str, int] | None = None,
    **kwargs,
) -> None:
    """Write ``df`` to a table (``overwrite`` drops and recreates it unless
    ``truncate``). Each partition commits on its own, so use it for staging
    or for publishing a complete snapshot, not as an atomic upsert.

    ``column_types`` (``createTableColumnTypes``) sets e.g. VARCHAR(n) for
    keyed or filtered text columns; ``max_length`` checks such bounds first.
    """
    if max_length:
        assert_fits(df, max_length)
    opts = jdbc_options(url, table, **kwargs)
    if truncate:
        opts["truncate"] = "true"
    if batch_size:
        opts["batchsize"] = str(batch_size)
    if column_types:
        opts["createTableColumnTypes"] = column_types
    df.write.format("jdbc").options(**opts).mode(mode).save()
