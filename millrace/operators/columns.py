"""Row-wise column operators. All of them also accept a streaming frame."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.names import standard_names

# The audit columns every written row carries.
INGESTED, PROCESSED, SOURCE = "_ingestion_timestamp", "_processing_date", "_source_system"


def apply_transformations(df: DataFrame, steps: Iterable[tuple[str, str]]) -> DataFrame:
    """Set columns to SQL expressions, in order; a later step sees what earlier ones made.

    A column that exists keeps its place. Catalyst folds the steps into one projection.
    """
    for name, expression in steps:
        df = df.withColumn(name, F.expr(expression))
    return df


def add_metadata(
    df: DataFrame,
    source_system: str,
    clock: Column | datetime | None = None,
    replace_metadata: bool = False,
) -> DataFrame:
    """Add when, on what day and from where a row was taken in.

    The default clock is the query's own start time. Columns that already have these names are an
    error unless ``replace_metadata``.
    """
    present = {name.lower() for name in df.columns}
    clashes = [name for name in (INGESTED, PROCESSED, SOURCE) if name in present]
    if clashes and not replace_metadata:
        raise ValueError(f"Audit columns are already present: {clashes}")
    if clock is None:
        moment, day = F.current_timestamp(), F.current_date()
    else:
        moment = clock if isinstance(clock, Column) else F.lit(clock)
        day = moment.cast("date")
    return df.withColumns({INGESTED: moment, PROCESSED: day, SOURCE: F.lit(source_system)})


def standardize_columns(df: DataFrame, on_collision: str = "error") -> DataFrame:
    """Normalise column names by position; see :func:`millrace.functions.names.standard_names`."""
    return df.toDF(*standard_names(df.columns, on_collision))


def standardize(
    df: DataFrame,
    source_system: str,
    clock: Column | datetime | None = None,
    replace_metadata: bool = False,
    on_collision: str = "error",
) -> DataFrame:
    """Audit columns, then normalised names."""
    return df.transform(add_metadata, source_system, clock, replace_metadata).transform(
        standardize_columns, on_collision
    )
