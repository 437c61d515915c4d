"""The first rows of each group by an order, without ever bringing a big group together.

Each task keeps the best of what it reads; groups are then cut by a salt, whose parts keep their best; what they kept is merged.
So a task gets at most ``k`` rows of a group from each task before, then from each salt, and a group that holds most rows is
no longer than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.spread import unused, with_hashes


def top_k(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str | Column],
    k: int,
    position: str | None = None,
    ties: bool = False,
    salts: int = 64,
) -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1 in a column ``position`` if it is named.

    With ``ties``, all rows that tie with the k-th stay and ``position`` is a rank. Without, rows that tie are told apart
    by a hash of the row, so which of them stay does not depend on how the data lie; of copies of a row any may. A null key is a group.
    Without ``by`` all rows are one group. The order of rows in the result is not defined.

    Spark keeps the best rows within each task before it shuffles if ``k`` is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold``; the salts bound what a task gets in any case.
    """
    if k < 1 or salts < 1:
        raise ValueError("k and salts must be one at least")
    if position is not None and position.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"The data already has a column {position}")
    rows, tie = with_hashes(df)
    keys = [_named(c) for c in by]
    order = [_named(c) if isinstance(c, str) else c for c in order_by]
    salt, number = unused([*rows.columns, position or ""], "__salt"), position or unused([*rows.columns], "__place")
    number_of = F.rank if ties else F.row_number
    order = order if ties else [*order, F.col(tie)]
    # The hash tells copies alike, so they are dealt by their task as well: a row that fills a group is not one salt's.
    rows = rows.withColumn(salt, F.pmod(F.xxhash64(F.col(tie), F.spark_partition_id()), F.lit(salts)))
    for window in (Window.partitionBy(*keys, F.col(salt)), Window.partitionBy(*keys)):
        rows = rows.withColumn(number, number_of().over(window.orderBy(*order))).where(F.col(number) <= k)
    rows = rows.withColumn(number, F.col(number).cast("long"))
    return rows.select(*[_named(c) for c in df.columns], *([F.col(number)] if position else []))


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
