"""Hashes of whole rows, and a checksum of a table that does not depend on the order of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType, VariantType

from millrace.formats import TIMESTAMP_FORMATS


def row_hashes(df: DataFrame, columns: list[str] | None = None) -> tuple[Column, Column]:
    """128 bits that stand for a row: two hashes of other seeds. Nulls count, in nested values too; -0.0 is 0.0.

    The order of columns counts and their names do not. Keys of a map count in the order in which they are stored.
    """
    fields = df.schema.fields if columns is None else [df.schema[c] for c in columns]
    # A hash passes over nulls, so where they are is hashed as well.
    nulls = F.concat(F.lit(""), *[F.when(_named(c.name).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in fields])
    contents = [nulls, *[_content(c) for c in fields]]
    return F.xxhash64(*contents), F.xxhash64(F.lit("again"), *contents)


def checksum(df: DataFrame) -> list[Column]:
    """Aggregates ``rows``, ``sum_1`` and ``sum_2``: equal for equal multisets of rows, and for others but by chance of 2**-128.

    Sums are decimals, which hold those of 10**18 rows.
    """
    sums = [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for h in row_hashes(df)]
    return [F.count(F.lit(1)).alias("rows"), *[value.alias(f"sum_{i}") for i, value in enumerate(sums, 1)]]


def _content(column: StructField) -> Column:
    """Simple values as they are; nested ones as text, which shows nulls within."""
    value = _named(column.name)
    if isinstance(column.dataType, (ArrayType, MapType, StructType, VariantType)):
        return F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false", **TIMESTAMP_FORMATS})
    return value


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
