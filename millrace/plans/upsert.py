"""Changes into a table of dated folders: only the days that they touch are written again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.spread import unused
from millrace.paths import path_exists, resolved
from millrace.plans.etl import RUN_DATE
from millrace.scratch import materialize
from millrace.sinks.files import write_files
from millrace.sources.files import read_files


@dataclass(frozen=True)
class UpsertResult:
    path: str
    days: tuple[str, ...]
    emptied: tuple[str, ...]
    rows: int | None


def upsert_days(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    day: str = RUN_DATE,
    fmt: str = "parquet",
    deleted: str | None = None,
) -> UpsertResult:
    """Put ``changes`` into the table of folders ``<day>=<value>`` below ``path``: a row replaces all rows of its key.

    ``changes`` holds the columns of the table, ``day`` among them, and a key once. A key may come with another day than it has:
    then it leaves its old one. ``deleted`` is a condition on the columns of ``changes`` (or more columns of it, which are not written);
    rows that meet it only delete. Nulls in keys are values; a null ``day`` is refused unless the row is deleted.

    The days are those of the changes and those where their keys are now, for which only keys are read. They are written to the side and
    put in place together, after everything has been read: a write that fails leaves all days as they were. A day that has lost all its
    rows is removed after that. Running the same changes again gives the same table, also if a run broke off in between.
    The days that change are gathered on the driver, one value each.
    """
    spark = changes.sparkSession
    gone = F.coalesce(F.expr(deleted), F.lit(False)) if deleted else F.lit(False)
    mark = unused(changes.columns, "__gone")
    changes = materialize(changes.withColumn(mark, gone), "changes")
    _check(changes, keys, day, mark)
    stored = _stored(spark, path, fmt, changes, day)
    columns = stored.columns if stored is not None else [c for c in changes.columns if c != mark]
    put = changes.where(~F.col(mark)).select(*map(_named, columns))
    if stored is None:
        days = _days(put, day)
        rows = write_files(put, path, fmt, "overwrite", [day], rebalance=True).rows if days else 0
        return UpsertResult(path, tuple(days), (), rows)
    changed = changes.select(*map(_named, keys)).toDF(*[unused(columns, f"__key_{i}") for i in range(len(keys))])
    same = reduce(and_, [_named(c).eqNullSafe(F.col(own)) for c, own in zip(keys, changed.columns)])
    held = stored.join(changed, same, "left_semi")
    days = sorted({*_days(put, day), *_days(held, day)})
    kept = stored.where(_named(day).cast("string").isin(days)).join(changed, same, "left_anti")
    after = materialize(kept.unionByName(put), "after")
    emptied = sorted({*days} - {*_days(after, day)})
    rows = write_files(after, path, fmt, "overwrite", [day], rebalance=True).rows if len(emptied) < len(days) else 0
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in emptied:
        folder, fs = resolved(spark, f"{path.rstrip('/')}/{escaped(day)}={escaped(value)}")
        fs.delete(folder, True)
    return UpsertResult(path, tuple(days), tuple(emptied), rows)


def _stored(spark: SparkSession, path: str, fmt: str, changes: DataFrame, day: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    folder, fs = resolved(spark, path)
    if not any(f.getPath().getName().startswith(f"{day}=") for f in fs.listStatus(folder)):
        return None
    found = read_files(spark, path, fmt)
    if day not in found.columns:
        raise ValueError(f"{path} holds no folders of {day}")
    kinds = {c.name: c.dataType for c in changes.schema}
    missing = [c for c in found.columns if c not in kinds]
    if missing:
        raise ValueError(f"The changes lack columns {', '.join(missing)}")
    odd = [c.name for c in found.schema if c.name != day and c.dataType.simpleString() != kinds[c.name].simpleString()]
    if odd:
        raise ValueError(f"The changes have other types in {', '.join(odd)}")
    return found.withColumn(day, _named(day).cast(kinds[day]))


def _check(changes: DataFrame, keys: Sequence[str], day: str, mark: str) -> None:
    for c in (*keys, day):
        if c not in changes.columns:
            raise ValueError(f"The changes have no column {c}")
    if not keys:
        raise ValueError("An upsert needs a key")
    if changes.schema[day].dataType.simpleString() not in ("date", "string"):
        raise ValueError(f"{day} is a date, or a date as text")
    if not changes.where(_named(day).isNull() & ~F.col(mark)).isEmpty():
        raise ValueError(f"The changes have rows without {day}")
    if not changes.groupBy(*map(_named, keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("The changes hold a key more than once")


def _days(rows: DataFrame, day: str) -> list[str]:
    found = [r[0] for r in rows.select(_named(day).cast("string")).distinct().collect()]
    if None in found:
        raise ValueError(f"The table has rows without {day} that change")
    return sorted(found)


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
