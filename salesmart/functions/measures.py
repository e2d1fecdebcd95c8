"""Money and measure aggregates.

Sales are stored as DOUBLE. Report totals are summed as DECIMAL so that the
third decimal does not depend on the order partial sums are combined in (a
double sum of a large group can differ in the last printed digit between two
runs with other partitioning). Each value is exact to 4 decimals before the
sum; the total is rounded half-up to 3 decimals once, at the end. Staging flags
amounts of 1e15 and more and text that is no finite number, so every staged
amount fits the partial type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output types of the reports.
MONEY_TYPE = "decimal(28,3)"
MONEY_PARTIAL_TYPE = "decimal(22,4)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_partial(c: Column | str = "sales") -> Column:
    """Exact partial sum (use when totals are re-aggregated later)."""
    return F.sum(_col(c).cast(MONEY_PARTIAL_TYPE))


def to_money(c: Column | str) -> Column:
    return _col(c).cast(MONEY_TYPE)


def money_sum(c: Column | str = "sales") -> Column:
    """``sum(sales)`` as a report total, decimal(28,3)."""
    return to_money(money_partial(c))


def units_sum(c: Column | str = "units") -> Column:
    return F.sum(_col(c)).cast("bigint")
