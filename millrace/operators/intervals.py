"""Interval join: pairs of rows whose intervals overlap, as equal joins on bins of time.

Bins are chosen from the lengths: an interval belongs to the level whose bins are the narrowest that are not shorter
than it, so it lies in two of them at most. A pair meets at the level of its longer interval: the longer one
with its own bins, the shorter one with those that it touches there. Of the bins that both touch only that of the later start
gives the pair. So a row is copied twice per level that the other side has (levels are powers of four: 32 at most), however unlike the
lengths are, and a bin holds no more than what truly lies close together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.spread import unused

_WIDEST = 62  # bits; wider intervals lie in several bins of this width


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    by: Sequence[tuple[str, str]] = (),
    closed: bool = False,
) -> DataFrame:
    """Columns of both sides for each pair whose spans (start, end) overlap and whose keys ``by`` are equal.

    A span reaches from its start up to, but without, its end; ``closed`` ones hold their end too. Starts and ends are whole numbers, dates or
    timestamps, of the same type on both sides. A span without any point (its end not after its start; if closed, before it) or with a null
    overlaps nothing, and a null key equals nothing. Repeated rows repeat. Both sides may not have a column of the same name.

    The levels of either side are counted when this is called.
    """
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if shared:
        raise ValueError(f"Both sides have columns named {', '.join(sorted(shared))}")
    kinds = {rows.schema[c].dataType.simpleString() for rows, span in ((left, left_span), (right, right_span)) for c in span}
    if len(kinds) > 1:
        raise ValueError(f"Starts and ends are of different types: {', '.join(sorted(kinds))}")
    taken = [*left.columns, *right.columns]

    def side(rows: DataFrame, span: tuple[str, str], prefix: str) -> tuple[DataFrame, dict[str, str]]:
        names = {part: unused(taken, f"__{prefix}_{part}") for part in ("first", "last", "level", "at", "bin")}
        first, last = (_whole(_named(c), rows.schema[c].dataType.simpleString()) for c in span)
        rows = rows.withColumns({names["first"]: first, names["last"]: last if closed else last - 1})
        first, last = F.col(names["first"]), F.col(names["last"])
        # Bits of the greatest distance within, rounded up to an even number; null if it does not fit a long.
        bits = F.length(F.bin(F.try_subtract(last, first)))
        bits = F.when(last == first, F.lit(0)).otherwise(F.coalesce(bits + bits % 2, F.lit(_WIDEST)))
        return rows.where(first <= last).withColumn(names["level"], F.least(bits, F.lit(_WIDEST))), names

    (left, a), (right, b) = side(left, left_span, "left"), side(right, right_span, "right")

    def levels(rows: DataFrame, names: dict[str, str]) -> list[int]:
        return sorted(r[0] for r in rows.select(names["level"]).distinct().collect())  # 32 at most

    def binned(rows: DataFrame, names: dict[str, str], at: Column) -> DataFrame:
        """A row for each bin of level ``at`` that the interval touches."""
        rows = rows.withColumn(names["at"], at)
        bins = (f"shiftright({names[end]}, {names['at']})" for end in ("first", "last"))
        return rows.withColumn(names["bin"], F.explode(F.expr(f"sequence({', '.join(bins)})")))

    def met(one: DataFrame, other: DataFrame) -> DataFrame:
        equal = [_named(x) == _named(y) for x, y in by]
        equal += [F.col(a[part]) == F.col(b[part]) for part in ("at", "bin")]
        overlap = [F.col(a["first"]) <= F.col(b["last"]), F.col(b["first"]) <= F.col(a["last"])]
        # The bin of the later start, so that a pair comes once.
        overlap.append(F.expr(f"shiftright(greatest({a['first']}, {b['first']}), {a['at']})") == F.col(a["bin"]))
        return one.join(other, reduce(and_, [*equal, *overlap]))

    def above(rows: DataFrame, names: dict[str, str], wanted: list[int], least: int) -> DataFrame:
        """The rows at every level that the other side's longer (or, with ``least`` 0, equally long) rows have."""
        level = F.col(names["level"])
        at = F.filter(F.array(*map(F.lit, wanted)).cast("array<int>"), lambda x: x >= level + least)
        return binned(rows.withColumn(names["at"], F.explode(at)), names, F.col(names["at"]))

    own_left, own_right = binned(left, a, F.col(a["level"])), binned(right, b, F.col(b["level"]))
    pairs = met(above(left, a, levels(right, b), 0), own_right).unionByName(met(own_left, above(right, b, levels(left, a), 1)))
    return pairs.select(*map(_named, taken))


def _whole(value: Column, kind: str) -> Column:
    if kind == "date":
        return F.unix_date(value).cast("long")
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "timestamp_ntz":
        # By the fields it shows, as no time zone is to be asked.
        seconds = (F.hour(value) * 60 + F.minute(value)) * 60 + F.extract(F.lit("SECOND"), value)
        return F.unix_date(value.cast("date")).cast("long") * 86_400_000_000 + (seconds * 1_000_000).cast("long")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("long")
    raise TypeError(f"Spans are whole numbers, dates or timestamps, not {kind}")


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
