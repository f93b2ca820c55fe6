"""Money arithmetic.

Staged prices are text (the relational loader stages every column as a
string). They are summed exactly, in integer cents, so the result is independent of
the order rows arrive in and partial sums on a thousand executors agree with
a single-node engine; only the final value is turned into a DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the exact type money is summed in.
MONEY = "decimal(18,2)"


def money(col: Column | str) -> Column:
    """Text or double to DECIMAL(18,2); bad text raises under ANSI."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


def money_sum(col: Column | str) -> Column:
    """Exact sum of money values (DECIMAL); cast with ``as_double`` at the end."""
    return F.sum(money(col))


def as_double(col: Column) -> Column:
    return col.cast("double")


def cents(col: Column | str) -> Column:
    """Exact integer cents of a 2-place money value (text or double)."""
    return (money(col) * 100).cast("bigint")


def cents_sum(col: Column | str) -> Column:
    """Exact sum in integer cents: primitive long arithmetic in the aggregate
    buffer, where a DECIMAL(18,2) sum would widen to DECIMAL(28,2) and run on
    big-decimal objects. Overflow raises under ANSI (beyond 9e16 units)."""
    return F.sum(cents(col))


def from_cents(col: Column) -> Column:
    """Integer cents to DOUBLE: the double nearest to the exact 2-place value,
    the same as casting the DECIMAL sum."""
    return (col.cast("decimal(20,0)") / F.lit(100)).cast("double")
