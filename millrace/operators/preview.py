"""A few rows of a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` rows; the same ones every time if ``order_by`` names a key.

    With an order Spark keeps ``n`` rows per task and never sorts the table.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)
