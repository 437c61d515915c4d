"""Telling rows of equal sort keys apart, so that a sort across tasks can split them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column is named so in any case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_hashes(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a hash of each row, and the name of that column. Copies of a row have the same hash."""
    name = unused(df.columns, "__tie")
    return df.withColumn(name, F.xxhash64(*_contents(df))), name


def with_numbers(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with numbers that differ even for copies of a row, without a shuffle, and the name of that column.

    Sorted by their content first, the rows of a task get the same numbers whenever it runs, in
    whatever order a shuffle delivers them: a task that is repeated after a sort has begun to
    read its output then sends each row to where it went before. Copies of a row differ in nothing
    else, so it does not matter which of them has which number.
    """
    name, contents = unused(df.columns, "__tie"), _contents(df)
    ordered = df.sortWithinPartitions(F.xxhash64(*contents), F.hash(*contents))
    return ordered.withColumn(name, F.monotonically_increasing_id()), name


def _contents(df: DataFrame) -> list[Column]:
    return [_content(column) for column in df.schema]


def _content(column: StructField) -> Column:
    """The column in a form that can be hashed."""
    value = F.col(f"`{column.name.replace('`', '``')}`")
    hashable = not any(word in column.dataType.simpleString() for word in ("map<", "variant"))
    return value if hashable else F.to_json(F.struct(value))
