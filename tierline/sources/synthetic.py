"""Ticket generator over any table of rows.

Every source row becomes one ticket; the customer, product and review text
are repeatable picks from the row id, the time is the row's own timestamp as
ISO-8601 text. It runs where the source rows are, with no shuffle, so it
scales with the table it is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.picks import pick_from, pick_int
from ..functions.timefmt import iso_text
from ..functions.triage import DEFAULT_RULES

# Product ids, customer id range and id prefixes of generated tickets.
PRODUCTS = [
    "PROD-1001", "PROD-1002", "PROD-1003", "PROD-1004", "PROD-1005",
    "PROD-1006", "PROD-1007", "PROD-1008", "PROD-1009",
]
CUSTOMER_LOW, CUSTOMER_HIGH = 5000, 9999
TICKET_PREFIX = "TCK-"
CUSTOMER_PREFIX = "CUST-"

# A review is an opening, a thing and a verdict, each picked by the row id.
# Some verdicts quote a keyword of the default triage rules, so every rule fires.
OPENINGS = ["After two weeks of use,", "To be honest,", "For the money,", "As a gift for my uncle,"]
THINGS = ["the kettle", "this lamp", "my new backpack", "the desk fan", "that router"]
VERDICTS = [
    "does its job well.",
    "is worth every cent.",
    "looks better than in the catalogue.",
    *[f"earns the remark '{word}' from me." for rule in DEFAULT_RULES for word in rule.keywords],
]

SALT_CUSTOMER, SALT_PRODUCT = 11, 23
TEXT_PARTS = ((37, OPENINGS), (41, THINGS), (43, VERDICTS))


def review_text(rid: Column) -> Column:
    """A review composed from the row id."""
    return F.concat_ws(" ", *[pick_from(rid, salt, values) for salt, values in TEXT_PARTS])


def tickets_from_rows(
    df: DataFrame,
    id_col: str,
    time_col: str | None = None,
    random_ids: bool = False,
    texts: list[str] | None = None,
) -> DataFrame:
    """Tickets with the landing schema, one per row of ``df``.

    ``random_ids`` uses ``uuid()`` for the ticket id (not repeatable);
    otherwise the id is derived from ``id_col``. ``texts`` replaces the
    composed reviews by picks from a list.
    """
    rid: Column = F.col(id_col)
    ticket_id = F.uuid() if random_ids else F.concat(F.lit(TICKET_PREFIX), rid.cast("string"))
    ts = iso_text(F.col(time_col)) if time_col else iso_text(F.current_timestamp())
    return df.select(
        ticket_id.alias("ticket_id"),
        F.concat(
            F.lit(CUSTOMER_PREFIX),
            pick_int(rid, SALT_CUSTOMER, CUSTOMER_LOW, CUSTOMER_HIGH).cast("string"),
        ).alias("customer_id"),
        pick_from(rid, SALT_PRODUCT, PRODUCTS).alias("product_id"),
        (pick_from(rid, TEXT_PARTS[-1][0], texts) if texts else review_text(rid)).alias("review_text"),
        ts.alias("timestamp"),
    )
