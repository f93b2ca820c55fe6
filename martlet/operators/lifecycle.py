"""Order lifecycle rules on staged time text.

Times are compared as ISO text (``yyyy-MM-dd HH:mm:ss``), which orders the
same as the times themselves for fixed-width text.

The order fact keeps an order when all four rules hold. SQL three-valued
logic decides the edge cases: a rule whose comparison is NULL is not TRUE,
so the row is dropped. In particular rule 1 drops an order with a NULL
purchase time and a non-NULL approval time.

The lifecycle check (a data test) lists orders breaking a rule; it guards
each comparison with explicit NOT NULL tests, so it is not the exact
complement of the filter when the purchase time is NULL.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names of the five lifecycle times in the order fact.
PURCHASE = "purchase_timestamp_id"
APPROVED = "approved_timestamp_id"
CARRIER = "delivered_carrier_timestamp_id"
DELIVERED = "delivered_customer_timestamp_id"
ESTIMATED = "estimated_delivery_timestamp_id"


# (earlier, later, whether a missing earlier time is accepted): the order of an
# order's life. A missing later time is always accepted.
PAIRS = (
    (PURCHASE, APPROVED, False),
    (APPROVED, CARRIER, True),
    (CARRIER, DELIVERED, True),
    (PURCHASE, ESTIMATED, False),
)


def lifecycle_rules() -> list[Column]:
    """One rule per pair; each may evaluate to NULL."""
    out = []
    for earlier, later, may_miss in PAIRS:
        rule = F.col(later).isNull() | (F.col(earlier) <= F.col(later))
        out.append(rule | F.col(earlier).isNull() if may_miss else rule)
    return out


def lifecycle_ok() -> Column:
    """Filter predicate: TRUE only when all rules are TRUE."""
    return reduce(and_, lifecycle_rules())


def lifecycle_violation() -> Column:
    """Data-test predicate: TRUE when a non-NULL pair is out of order."""
    return reduce(or_, [F.col(earlier) > F.col(later) for earlier, later, _ in PAIRS])
