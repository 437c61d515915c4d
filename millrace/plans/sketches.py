"""Numbers of distinct values and quantiles of dated data, from sketches that days are merged from.

A day's facts are read once, when its sketches are written: a row per group, a few kilobytes each. Any span of days, and any coarser
grouping, is then merged from these rows alone, and no fact is read again. A rerun of a day replaces its sketches.

Distinct values are counted by HyperLogLog sketches of ``2**lg_k`` cells, with a standard error of ``1.04 / 2**(lg_k / 2)`` (0.8 % for 14).
Quantiles come from KLL sketches: for ``k`` = 800 the rank of what is returned is within 0.4 % of the one asked for, in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.etl import RUN_DATE, PipelineResult, Target, deliver
from millrace.sources.files import read_files

_PLAIN = ("int", "bigint", "string", "binary")


def sketches(df: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = (), lg_k: int = 14, k: int = 800) -> DataFrame:
    """``by``, ``rows``, and per column ``<column>_distinct`` and ``<column>_quantiles``, sketches as binary values.

    Nulls (and, among quantiles, what is no number) are left out, as ``count(distinct)`` and percentiles do; a null in ``by`` is a group.
    Tasks sketch what they read and only sketches are shuffled, so a group may hold any share of the rows.
    """
    made = {f"{c}_distinct": F.hll_sketch_agg(_plain(df, c), F.lit(lg_k)) for c in distinct}
    for c in quantiles:
        value = _named(c).cast("double")
        made[f"{c}_quantiles"] = F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(k))
    clash = {"rows", *made} & {c.lower() for c in by}
    if clash:
        raise ValueError(f"Grouping columns are named like results: {', '.join(sorted(clash))}")
    return df.groupBy(*map(_named, by)).agg(F.count(F.lit(1)).alias("rows"), *[value.alias(name) for name, value in made.items()])


def write_sketches(
    df: DataFrame,
    path: str,
    run_date: date | str,
    by: Sequence[str],
    distinct: Sequence[str] = (),
    quantiles: Sequence[str] = (),
    lg_k: int = 14,
    k: int = 800,
) -> PipelineResult:
    """Write a day's sketches into its folder below ``path``. All days of a path must be made with the same columns."""
    return deliver(sketches(df, by, distinct, quantiles, lg_k, k), Target(path, "parquet", run_date=run_date))


def merge_sketches(
    spark: SparkSession,
    path: str,
    first: date | str,
    last: date | str,
    by: Sequence[str] = (),
    ranks: Mapping[str, float] | None = None,
) -> DataFrame:
    """``by``, ``rows``, the estimated ``<column>_distinct`` and, per name in ``ranks``, ``<column>_<name>`` over the days from ``first`` to ``last``.

    ``by`` are some or all of the columns that the sketches were grouped by. ``ranks`` names ranks between 0 and 1, ``{"median": 0.5}`` if not
    given. Only folders of those days are read. Where a group has no value, the number is 0 and quantiles are null.
    """
    stored = read_files(spark, path, "parquet").where(F.col(RUN_DATE).cast("string").between(str(first), str(last)))
    ranks = {"median": 0.5} if ranks is None else dict(ranks)
    counted = [c for c in stored.columns if c.endswith("_distinct") and stored.schema[c].dataType.simpleString() == "binary"]
    spread = [c for c in stored.columns if c.endswith("_quantiles") and stored.schema[c].dataType.simpleString() == "binary"]
    merged = stored.groupBy(*map(_named, by)).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.hll_union_agg(_named(c)).alias(c) for c in counted],
        *[F.kll_merge_agg_double(_named(c)).alias(c) for c in spread],
    )
    out = [F.coalesce(F.hll_sketch_estimate(_named(c)), F.lit(0)).cast("long").alias(c) for c in counted]
    for c in spread:
        held = F.when(F.kll_sketch_get_n_double(_named(c)) > 0, _named(c))
        out += [F.kll_sketch_get_quantile_double(held, F.lit(float(rank))).alias(f"{c.removesuffix('quantiles')}{name}") for name, rank in ranks.items()]
    return merged.select(*map(_named, by), "rows", *out)


def _plain(df: DataFrame, name: str) -> Column:
    """The column in a type that can be counted: equal values stay equal."""
    kind = df.schema[name].dataType.simpleString()
    return _named(name) if kind in _PLAIN else _named(name).cast("string")


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
