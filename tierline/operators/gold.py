"""Gold aggregation: per-product review count, mean urgency, sentiment counts.

One ``groupBy`` with partial (map-side) aggregation: each map task combines
its rows per product before the shuffle, so a product holding a third of all
rows costs one shuffled row per map task, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentiment labels counted into the gold table.
NEGATIVE = "Negative"
POSITIVE = "Positive"

RATING_TYPE = "decimal(4,2)"


def product_metrics(
    df: DataFrame,
    key: str = "product_id",
    ticket: str = "ticket_id",
    urgency: str = "urgency_score",
    sentiment: str | None = None,
    rating: bool = False,
) -> DataFrame:
    """Per ``key``: ``total_reviews`` = non-null ``ticket`` count (repeats count
    twice), ``avg_urgency`` = mean ignoring nulls (null when all are null).

    ``sentiment`` adds ``negative_ticket_count`` and ``positive_ticket_count``
    (null sentiment counts in neither); ``rating`` adds ``avg_urgency_rating``,
    the mean rounded half-up to decimal(4,2), null when it does not fit.
    A null key forms its own group.
    """
    mean = F.avg(F.col(urgency))
    aggs = [F.count(F.col(ticket)).alias("total_reviews"), mean.alias("avg_urgency")]
    if rating:
        aggs.append(mean.try_cast(RATING_TYPE).alias("avg_urgency_rating"))
    if sentiment:
        aggs.append(F.count_if(F.col(sentiment) == F.lit(NEGATIVE)).alias("negative_ticket_count"))
        aggs.append(F.count_if(F.col(sentiment) == F.lit(POSITIVE)).alias("positive_ticket_count"))
    return df.groupBy(key).agg(*aggs)


def sentiment_counts(df: DataFrame, key: str = "product_id", sentiment: str = "sentiment") -> DataFrame:
    """Per ``key``: negative and positive ticket counts (0 when none)."""
    return df.groupBy(key).agg(
        F.count_if(F.col(sentiment) == F.lit(NEGATIVE)).alias("negative_ticket_count"),
        F.count_if(F.col(sentiment) == F.lit(POSITIVE)).alias("positive_ticket_count"),
    )


def rounded_rating(df: DataFrame, key: str = "product_id", urgency: str = "urgency_score") -> DataFrame:
    """Per ``key``: mean urgency as decimal(4,2), half-up; null above 99.99."""
    return df.groupBy(key).agg(F.avg(F.col(urgency)).try_cast(RATING_TYPE).alias("avg_urgency_rating"))
