"""Exact sums of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column | str) -> Column:
    """An amount as a decimal with two digits, so that sums do not depend on row order."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return column.cast("decimal(18,2)")


def wide(total: Column | str) -> Column:
    column = F.col(total) if isinstance(total, str) else total
    return column.cast("decimal(38,2)")


def total_of(amount: Column | str) -> Column:
    """Null when there is no row to add."""
    return wide(F.sum(cents(amount)))
