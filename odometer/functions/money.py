"""Money arithmetic that gives the same digits in every SQL engine.

Rounding is Spark's ``round``: HALF_UP applied to the double's shortest
decimal text (1.005 -> 1.01, 2.675 -> 2.68), exactly the rule the reference
relies on; NaN stays NaN.  Another engine reproduces it by rounding that text
as a wide DECIMAL (the oracle does).  A double ``sum`` depends on addition
order, so sums of two-decimal amounts can be taken as DECIMAL(18,2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMAL = "decimal(18,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: Column | str, exact: bool = True) -> Column:
    """Sum of two-decimal amounts; ``exact`` sums as DECIMAL(18,2), so the digits
    don't depend on the order of addition.

    With ``exact=False`` this is the plain double ``sum`` (order dependent,
    and NaN-propagating).  With ``exact=True`` an amount that is no number or
    too large fails the query: it never leaves the sum silently.
    """
    c = _col(c)
    return F.sum(c.cast(MONEY_DECIMAL)).cast("double") if exact else F.sum(c)


def to_decimal(c: Column | str, precision: int, scale: int) -> Column:
    """Conform a double to NUMERIC(precision, scale) with HALF_UP rounding;
    NaN or out-of-range values become NULL (and then fail NOT NULL checks)."""
    return F.round(_col(c), scale).try_cast(f"decimal({precision},{scale})")
