"""Adapters from the driver's tables to the tiers' input shapes.

Each adapter exists twice: as a Spark DataFrame and as SQL text for an
independent engine (DuckDB) reading the same parquet tables, so that a query
and its oracle share only the input, never the engine.

* EV  - ``events`` as raw text events, as a real feed would carry them:
        ``error`` events arrive without an event id, events with ``value < 5``
        come from a client that writes the time as ``MM/dd/yyyy HH:mm:ss`` (not
        ISO, so lenient parsing yields null), events with ``value >= 100`` are
        of guests whose id no dimension has, and those below 1 have no user.
* DIM - ``customer`` as the user dimension, every customer, keyed by
        ``user_id`` text.
* TK  - ``documents`` as tickets: ``source`` is the product, the text the
        review, the time derived from the document id.
* LB  - TK joined with ``labels``: ``quality`` as urgency, ``toxic`` as
        sentiment (unlabeled documents have nulls).
* LI  - ``lineitem`` as gold input at scale: part as product, order as
        ticket, quantity as urgency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.picks import lehmer_sql, pick_int
from .functions.timefmt import ISO_MICROS, ISO_SECONDS
from .sources.synthetic import CUSTOMER_HIGH, CUSTOMER_LOW, CUSTOMER_PREFIX, SALT_CUSTOMER

LEGACY_TIME = "MM/dd/yyyy HH:mm:ss"
LEGACY_TIME_SQL = "%m/%d/%Y %H:%M:%S"
ISO_MICROS_SQL = "%Y-%m-%dT%H:%M:%S.%fZ"
ISO_SECONDS_SQL = "%Y-%m-%dT%H:%M:%SZ"
TICKET_EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- EV
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("event_type") != F.lit("error"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("value") >= F.lit(100.0), F.concat(F.lit("guest-"), F.col("user_id").cast("string")))
        .when(F.col("value") >= F.lit(1.0), F.col("user_id").cast("string"))
        .alias("user_id"),
        F.col("event_type"),
        F.when(F.col("value") < F.lit(5.0), F.date_format("ts", LEGACY_TIME))
        .otherwise(F.date_format("ts", ISO_MICROS))
        .alias("timestamp"),
        F.col("props").alias("payload"),
    )


RAW_EVENTS_SQL = f"""
    select case when event_type <> 'error' then cast(event_id as varchar) end as event_id,
           case when value >= 100.0 then 'guest-' || cast(user_id as varchar)
                when value >= 1.0 then cast(user_id as varchar) end as user_id,
           event_type,
           case when value < 5.0 then strftime(ts, '{LEGACY_TIME_SQL}')
                else strftime(ts, '{ISO_MICROS_SQL}') end as "timestamp",
           props as payload
    from events"""


# ---------------------------------------------------------------- DIM
def user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
    )


USER_DIMENSION_SQL = """
    select cast(c_custkey as varchar) as user_id, c_name, c_nationkey, c_acctbal, c_mktsegment
    from customer"""

DIMENSION_COLUMNS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


# ---------------------------------------------------------------- TK
def doc_tickets(spark: SparkSession, sf_dir: str, *extra) -> DataFrame:
    """Tickets from documents; ``extra`` columns of ``documents`` are appended."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")).alias("ticket_id"),
        F.concat(
            F.lit(CUSTOMER_PREFIX),
            pick_int(F.col("doc_id"), SALT_CUSTOMER, CUSTOMER_LOW, CUSTOMER_HIGH).cast("string"),
        ).alias("customer_id"),
        F.col("source").alias("product_id"),
        F.col("text").alias("review_text"),
        F.date_format(
            F.timestamp_add("MINUTE", F.col("doc_id"), F.lit(TICKET_EPOCH).cast("timestamp_ntz")),
            ISO_SECONDS,
        ).alias("timestamp"),
        *extra,
    )


def doc_tickets_sql(extra: str = "") -> str:
    return f"""
    select 'DOC-' || cast(doc_id as varchar) as ticket_id,
           '{CUSTOMER_PREFIX}' || cast({CUSTOMER_LOW} + ({lehmer_sql('doc_id', SALT_CUSTOMER)})
               % {CUSTOMER_HIGH - CUSTOMER_LOW + 1} as varchar) as customer_id,
           source as product_id,
           text as review_text,
           strftime(timestamp '{TICKET_EPOCH}' + doc_id * interval 1 minute, '{ISO_SECONDS_SQL}')
               as "timestamp"{extra}
    from documents"""


DOC_TICKETS_SQL = doc_tickets_sql()

TICKET_COLUMNS = ["ticket_id", "customer_id", "product_id", "review_text", "timestamp"]


# ---------------------------------------------------------------- LB
def labeled_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, on="doc_id", how="left").select(
        F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")).alias("ticket_id"),
        F.col("source").alias("product_id"),
        F.col("quality").cast("double").alias("urgency_score"),
        F.when(F.col("toxic") == 1, F.lit("Negative"))
        .when(F.col("toxic") == 0, F.lit("Positive"))
        .alias("sentiment"),
    )


LABELED_TICKETS_SQL = """
    select 'DOC-' || cast(d.doc_id as varchar) as ticket_id,
           d.source as product_id,
           cast(l.quality as double) as urgency_score,
           case when l.toxic = 1 then 'Negative' when l.toxic = 0 then 'Positive' end as sentiment
    from documents d left join labels l on d.doc_id = l.doc_id"""


# ---------------------------------------------------------------- LI
def line_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_quantity").alias("urgency_score"),
    )


LINE_TICKETS_SQL = """
    select l_partkey as product_id, l_orderkey as ticket_id, l_quantity as urgency_score
    from lineitem"""
