"""A query with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(amount: str) -> str:
    """SQL for an exact sum, the counterpart of ``functions.money.total_of``."""
    return f"cast(sum(cast({amount} as decimal(18,2))) as decimal(38,2))"
