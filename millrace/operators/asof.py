"""As-of join: to each row of one table the latest row of another up to its time, hot keys split.

Both sides are put in one order per key, and the last row of the right side is carried to the left side's rows. That is a
running column of :func:`millrace.operators.ordered.moving`: keys of more than ``block`` rows are cut into blocks, so
no task ever holds one, and every row is moved as often as in a sort, whatever the number of matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import Running, moving
from millrace.operators.spread import with_hashes


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    by: Sequence[tuple[str, str]] = (),
    direction: str = "backward",
    exact: bool = True,
    tolerance: timedelta | float | None = None,
    how: str = "left",
    ties: Sequence[str] = (),
    block: int | None = 1 << 20,
) -> DataFrame:
    """Columns of ``left``, then those of the row of ``right`` that is the latest up to it (``forward``: the first from it on).

    ``on`` names the time of either side (anything that has an order), ``by`` pairs of equal keys. Without ``exact`` a row
    of the same time is not taken. What is further away than ``tolerance`` (of the type of a difference of times: a
    ``timedelta`` for timestamps) is no match. ``how`` is ``left``, which gives nulls where there is no match, or ``inner``.

    Of several rows of ``right`` with the same key and time, the last one by ``ties`` counts (columns of ``right``, ascending, a hash of the
    row after that, whatever the direction). A null key or time matches nothing. Each row of ``left`` comes once, or not at all; repeated rows
    repeat. Both sides may not have a column of the same name. ``block`` is that of :func:`moving`.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, how is left or inner")
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if shared:
        raise ValueError(f"Both sides have columns named {', '.join(sorted(shared))}")
    backward, (left_time, right_time) = direction == "backward", on
    hashed, tie = with_hashes(right)
    keys = [f"key_{i}" for i in range(len(by))]

    def side(rows: DataFrame, time: str, own: Sequence[str], second: bool, columns: dict[str, Column]) -> DataFrame:
        named = [_named(c).alias(k) for c, k in zip(own, keys)]
        return rows.select(*named, _named(time).alias("time"), F.lit(int(second)).alias("second"), *[v.alias(k) for k, v in columns.items()])

    # At the same time, the right side's rows come first where they count.
    asking = side(left, left_time, [a for a, _ in by], exact, {"asking": _row(left)})
    marks = F.struct(*map(_named, ties), tie).alias("tie")
    given = hashed.where(" and ".join(["true", *(f"{_quoted(c)} is not null" for c in (right_time, *(b for _, b in by)))]))
    given = side(given, right_time, [b for _, b in by], not exact, {"given": _row(right), "tie": marks})
    both = asking.unionByName(given, allowMissingColumns=True)
    time = F.asc_nulls_first("time") if backward else F.desc_nulls_first("time")
    found = moving(both, keys, [time, "second", "tie"], {"match": Running("last", "given")}, block=block)
    match = F.col("match")
    if tolerance is not None:
        near, far = match.getField(right_time), F.lit(tolerance)
        close = near >= F.col("time") - far if backward else near <= F.col("time") + far
        match = F.when(close, match)
    found = found.where(F.col("asking").isNotNull()).select("asking", match.alias("match"))
    if how == "inner":
        found = found.where(F.col("match").isNotNull())
    return found.select(
        *[F.col("asking").getField(c).alias(c) for c in left.columns], *[F.col("match").getField(c).alias(c) for c in right.columns]
    )


def _row(rows: DataFrame) -> Column:
    return F.struct(*map(_named, rows.columns))


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _named(name: str) -> Column:
    return F.col(_quoted(name))
