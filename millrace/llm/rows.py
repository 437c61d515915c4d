"""Helpers on columns that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` is named so in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text: two XXH64 values from different seeds. A null is the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)
