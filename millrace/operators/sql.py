"""SQL text over frames."""

from __future__ import annotations

from collections.abc import Mapping
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: View names belong to the session, so texts are analysed one at a time. What they say runs later, side by side.
_ANALYSIS = RLock()


def sql_transform(
    df: DataFrame,
    sql: str,
    view: str = "source_data",
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run one SQL statement that sees ``df`` as ``view``, and each of ``tables`` by its name.

    The views exist only while the text is analysed. A name that is already a view or table is
    refused rather than shadowed.
    """
    spark = df.sparkSession
    made: list[str] = []
    with _ANALYSIS:
        try:
            for name, frame in {**(tables or {}), view: df}.items():
                if spark.catalog.tableExists(name):
                    raise ValueError(f"A view or table named {name!r} exists already")
                # Dropping a view uncaches a frame of the same plan; the filter, which Catalyst
                # removes, keeps the caller's cached frame out of that.
                frame.where(F.lit(True)).createTempView(name)
                made.append(name)
            return spark.sql(sql)
        finally:
            for name in made:
                spark.catalog.dropTempView(name)
