"""Database query scans."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

# Session properties an Oracle connection is opened with.
ORACLE_PROPERTIES = {
    "oracle.jdbc.timezoneAsRegion": "false",
    "oracle.net.disableOob": "true",
}


def derived_table(query: str, alias: str) -> str:
    """``query`` as a table expression; no ``AS``, which some databases reject before an alias."""
    return f"({query.strip().rstrip(';').rstrip()}\n) {alias}"  # the query may end in a line comment


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    options: Mapping[str, object] | None = None,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetchsize: int = 10000,
) -> DataFrame:
    """Read the result of ``query``; filters and column choices made later still reach the database.

    The database runs the query once per partition. By default that is one partition. Give
    ``partition_column`` and ``num_partitions`` to split its range evenly; bounds that are left
    out are asked from the database. They only place the splits: rows outside them, and rows
    whose column is null, are read too. When the column is unevenly filled, give ``predicates``
    instead, one condition per partition, for example on a hash of the key; together they must
    cover every row exactly once.

    ``options`` holds user, password, driver and any property of the driver. Neither it nor the
    URL is ever printed.
    """
    defaults = {"fetchsize": fetchsize}
    if url.lower().startswith("jdbc:oracle:"):
        defaults.update(ORACLE_PROPERTIES)
    properties = {key: str(value) for key, value in {**defaults, **(options or {})}.items()}
    table = derived_table(query, "src")

    if predicates is not None:
        if partition_column is not None:
            raise ValueError("Give either predicates or partition_column")
        if not predicates:
            raise ValueError("predicates must not be empty")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)

    if partition_column is None:
        if (lower, upper, num_partitions) != (None, None, None):
            raise ValueError("lower, upper and num_partitions need a partition_column")
        return _reader(spark, url, properties).option("dbtable", table).load()

    if num_partitions is None:
        raise ValueError("partition_column needs num_partitions")
    if lower is None or upper is None:
        found = _bounds(spark, url, properties, query, partition_column)
        lower = found[0] if lower is None else lower
        upper = found[1] if upper is None else upper
    reader = _reader(spark, url, properties).option("dbtable", table)
    if lower is None or upper is None:  # no row has a key
        return reader.load()
    return reader.options(
        partitionColumn=partition_column,
        lowerBound=_bound(lower, math.floor),
        upperBound=_bound(upper, math.ceil),
        numPartitions=num_partitions,
    ).load()


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**properties).option("url", url)


def _bound(value: object, whole: Callable[[Decimal | float], int]) -> str:
    """Spark takes whole numbers only, also for decimal keys."""
    return str(whole(value) if isinstance(value, (Decimal, float)) else value)


def _bounds(
    spark: SparkSession, url: str, properties: Mapping[str, str], query: str, column: str
) -> tuple[object, object]:
    """Least and greatest key: one row, computed by the database."""
    ends = f"select min({column}) lo, max({column}) hi from {derived_table(query, 'src')}"
    row = _reader(spark, url, properties).option("dbtable", derived_table(ends, "ends")).load().first()
    return row[0], row[1]
