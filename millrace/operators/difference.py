"""What two tables differ in, with multiplicity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.contents import row_hashes
from millrace.operators.spread import unused
from millrace.scratch import materialize


def difference(old: DataFrame, new: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows that ``old`` and ``new`` do not have equally often: their columns, ``change``, ``n_old`` and ``n_new``.

    ``change`` is ``added`` or ``removed``: there are more of the row in ``new``, or fewer. With ``keys``, it is ``changed`` where
    both tables have rows of the key: the row with more in ``old`` is what was, the one with more in ``new`` what is. A null key is a
    key, and equal nulls are equal, in nested values too. Columns have to be the same by name and type; their order is that of ``old``.

    Only hashes of rows and keys are shuffled, and summed up before, so a row or key that fills a table is a row per task. Rows
    themselves are read again, and only those that differ are moved.
    """
    kinds = {c: old.schema[c].dataType.simpleString() for c in old.columns}
    if kinds != {c: new.schema[c].dataType.simpleString() for c in new.columns}:
        raise ValueError("The tables have other columns or types")
    taken = {"change", "n_old", "n_new"} & {c.lower() for c in old.columns}
    if taken:
        raise ValueError(f"The data already has columns {', '.join(sorted(taken))}")
    missing = [c for c in keys if c not in old.columns]
    if missing:
        raise ValueError(f"No columns {', '.join(missing)}")
    new = new.select(*map(_named, old.columns))
    names = [unused(old.columns, f"__{part}") for part in ("h1", "h2", "k1", "k2")]
    h1, h2, k1, k2 = names

    def hashed(rows: DataFrame) -> DataFrame:
        key = row_hashes(rows, list(keys)) if keys else (F.lit(0).cast("long"),) * 2
        return rows.withColumns(dict(zip(names, [*row_hashes(rows), *key])))

    old, new = hashed(old), hashed(new)
    both = old.select(*names, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(new.select(*names, F.lit(0).alias("o"), F.lit(1).alias("n")))
    # A row has its key, so rows of a key are grouped by what they are grouped by anyway.
    counts = both.groupBy(*names).agg(F.sum("o").alias("n_old"), F.sum("n").alias("n_new"))
    counts = materialize(counts, "counts") if keys else counts
    apart = counts.where("n_old <> n_new")
    if keys:
        sides = counts.groupBy(k1, k2).agg((F.sum("n_old") > 0).alias("in_old"), (F.sum("n_new") > 0).alias("in_new"))
        both_sides = materialize(sides.where("in_old and in_new").select(k1, k2, F.lit(True).alias("both")), "keys")
        apart = apart.join(both_sides, [k1, k2], "left")
    else:
        apart = apart.withColumn("both", F.lit(None).cast("boolean"))
    change = F.when(F.col("both"), "changed").when(F.col("n_old") > F.col("n_new"), "removed").otherwise("added")
    apart = materialize(apart.select(h1, h2, change.alias("change"), "n_old", "n_new"), "apart")
    columns = [c for c in old.columns if c not in names]

    def contents(rows: DataFrame, which: str) -> DataFrame:
        """One row of each content; copies are folded by their tasks first."""
        own = apart.where(which).select(F.col(h1).alias("own_1"), F.col(h2).alias("own_2"))
        same = reduce(and_, [_named(a) == F.col(b) for a, b in ((h1, "own_1"), (h2, "own_2"))])
        some = rows.join(own, same, "left_semi").select(h1, h2, F.struct(*map(_named, columns)).alias("row"))
        return some.groupBy(h1, h2).agg(F.first("row").alias("row"))

    rows = contents(old, "n_old > n_new").unionByName(contents(new, "n_old < n_new"))
    found = rows.join(apart, [h1, h2])
    return found.select(*[F.col("row").getField(c).alias(c) for c in columns], "change", "n_old", "n_new")


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
