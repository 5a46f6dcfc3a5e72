"""Struct types of the tiers (landing, bronze, silver, gold)."""

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Column names and types of the tiers are the data contract.

# One support ticket as it lands: five text fields.
TICKET = _strings("ticket_id", "customer_id", "product_id", "review_text", "timestamp")

# Column that keeps the raw text of a landing file (or line) that did not parse.
CORRUPT = "_corrupt_record"

# One raw event as it lands: five text fields, payload kept as JSON text.
RAW_EVENT = _strings("event_id", "user_id", "event_type", "timestamp", "payload")

# Triage result carried as a struct (and as JSON text with the same key order).
TRIAGE = StructType(
    [
        StructField("sentiment", StringType(), True),
        StructField("urgency_score", IntegerType(), True),
        StructField("summary", StringType(), True),
    ]
)
TRIAGE_DDL = "sentiment string, urgency_score int, summary string"

# The gold target: union of the two target shapes (job and migration).
GOLD_TARGET = StructType(
    [
        StructField("product_id", StringType(), False),
        StructField("total_reviews", LongType(), False),
        StructField("avg_urgency", DoubleType(), True),
        StructField("avg_urgency_rating", DecimalType(4, 2), True),
        StructField("negative_ticket_count", LongType(), False),
        StructField("positive_ticket_count", LongType(), False),
        StructField("last_updated_at", TimestampType(), True),
    ]
)
GOLD_KEY = "product_id"
GOLD_STAMP = "last_updated_at"

# Defaults for gold columns a target may lack (see sinks.snapshots.evolve).
GOLD_DEFAULTS = {
    "total_reviews": 0,
    "negative_ticket_count": 0,
    "positive_ticket_count": 0,
    "avg_urgency_rating": "0.00",
}

# Bounded text columns of the serving database.
GOLD_MAX_LENGTH = {"product_id": 255}
