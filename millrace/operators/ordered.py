"""Row numbers, ranks, lags and leads, rolling and running frames that never hold a big group in one task.

A plain window sorts each group in one task, which is right as long as groups are small. So groups
are counted first. The rows of those above a bound are range-partitioned by group and order and
numbered from end to end; the numbers cut them into blocks, and the window runs per block. A group
of any size so spreads over many tasks, and all other rows take the plain window. Columns are declared, so that
both ways give the same values. Some look back or ahead a known number of rows, which the block then sees too. Others
depend on all rows before: each block is summed up (totals, last values, the rank of its last peers), a prefix over
the blocks of a group carries that into every block, and the block's rows add it to what they have.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.operators.spread import unused, with_numbers
from millrace.scratch import materialize

_ID_BITS = 33  # monotonically_increasing_id keeps the row within the partition in the low bits
_MAX_BIG = 100_000  # groups above the bound: a window over one row each of them is one task's work
_HOW = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "count": F.count}


def _last(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


_RUNNING = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "last": _last}


class _Ordered:
    """A window column: rows seen before and after, and how it is made of a block and what is carried into it."""

    reach = 0
    ahead = 0

    def over(self, window: WindowSpec) -> Column:
        raise NotImplementedError


class _Carried(_Ordered):
    """A column that depends on all rows before."""

    def local(self, window: WindowSpec, order: list[Column], own: Column) -> dict[str, Column]:
        """Columns of a block's rows; ``own`` tells them from rows of its neighbours."""
        raise NotImplementedError

    def total(self, part: dict[str, Column], own: Column, earlier: Column, place: Column) -> dict[str, Column]:
        """Aggregates of a block; ``part`` are its local columns, ``earlier`` tells rows of the block before."""
        raise NotImplementedError

    def carry(self, total: dict[str, Column], before: WindowSpec, start: Column, copied: Column) -> dict[str, Column]:
        """What comes into a block, which begins at place ``start`` and sees ``copied`` rows of the one before."""
        raise NotImplementedError

    def whole(self, part: dict[str, Column], carry: dict[str, Column], start: Column, copied: Column) -> Column:
        """The column, made of both."""
        raise NotImplementedError


@dataclass(frozen=True)
class Lag(_Ordered):
    """The value of ``column`` ``n`` rows before; null where the group does not reach back so far."""

    column: str
    n: int = 1

    @property
    def reach(self) -> int:
        return self.n

    def over(self, window: WindowSpec) -> Column:
        return F.lag(_named(self.column), self.n).over(window)


@dataclass(frozen=True)
class Lead(_Ordered):
    """The value of ``column`` ``n`` rows after; null where the group does not go on so far."""

    column: str
    n: int = 1

    @property
    def ahead(self) -> int:
        return self.n

    def over(self, window: WindowSpec) -> Column:
        return F.lead(_named(self.column), self.n).over(window)


@dataclass(frozen=True)
class Rolling(_Ordered):
    """``how`` (sum, min, max, avg, count) of ``column`` over the last ``rows`` rows, this one included."""

    how: str
    column: str
    rows: int

    @property
    def reach(self) -> int:
        return self.rows - 1

    def over(self, window: WindowSpec) -> Column:
        return _HOW[self.how](_named(self.column)).over(window.rowsBetween(1 - self.rows, 0))


@dataclass(frozen=True)
class Running(_Carried):
    """``how`` of ``column`` over all rows up to this one: sum, min, max, count, avg (sum through count) or last.

    ``last`` is the latest value that is not null. Sums of doubles may differ in their last bits between blocks and
    a plain window, as the order of additions does; sums of decimals and whole numbers are the same.
    """

    how: str
    column: str

    def over(self, window: WindowSpec) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, 0)
        return self._value({how: _RUNNING[how](_named(self.column)).over(frame) for how in self._parts})

    @property
    def _parts(self) -> tuple[str, ...]:
        return ("sum", "count") if self.how == "avg" else (self.how,)

    def _value(self, parts: dict[str, Column]) -> Column:
        return parts["sum"] / parts["count"] if self.how == "avg" else parts[self.how]

    def local(self, window: WindowSpec, order: list[Column], own: Column) -> dict[str, Column]:
        frame, value = window.rowsBetween(Window.unboundedPreceding, 0), F.when(own, _named(self.column))
        return {how: _RUNNING[how](value).over(frame) for how in self._parts}

    def total(self, part: dict[str, Column], own: Column, earlier: Column, place: Column) -> dict[str, Column]:
        value = _named(self.column)
        last = F.max_by(value, F.when(own & value.isNotNull(), place))
        return {how: last if how == "last" else _RUNNING[how](F.when(own, value)) for how in self._parts}

    def carry(self, total: dict[str, Column], before: WindowSpec, start: Column, copied: Column) -> dict[str, Column]:
        return {how: (F.sum if how == "count" else _RUNNING[how])(value).over(before) for how, value in total.items()}

    def whole(self, part: dict[str, Column], carry: dict[str, Column], start: Column, copied: Column) -> Column:
        joined = {}
        for how in self._parts:
            here, before = part[how], carry[how]
            if how in ("sum", "count"):
                joined[how] = F.coalesce(here + before, here, before)
            else:
                joined[how] = F.coalesce(here, before) if how == "last" else {"min": F.least, "max": F.greatest}[how](here, before)
        return self._value(joined)


@dataclass(frozen=True)
class Rank(_Carried):
    """One more than the number of rows that come earlier in the order; rows that tie have the same."""

    reach = 1

    def over(self, window: WindowSpec) -> Column:
        return F.rank().over(window).cast("long")

    def local(self, window: WindowSpec, order: list[Column], own: Column) -> dict[str, Column]:
        return {"rank": F.rank().over(window.orderBy(*order)).cast("long")}

    def total(self, part: dict[str, Column], own: Column, earlier: Column, place: Column) -> dict[str, Column]:
        return {"rank": F.max(F.when(own, part["rank"]))}

    def carry(self, total: dict[str, Column], before: WindowSpec, start: Column, copied: Column) -> dict[str, Column]:
        # The rank of a block's last row, if its peers begin in the block; the last one known is that of all its peers.
        return {"known": _last(F.when(total["rank"] > copied, start - copied + total["rank"])).over(before)}

    def whole(self, part: dict[str, Column], carry: dict[str, Column], start: Column, copied: Column) -> Column:
        return F.when(part["rank"] > copied, start - copied + part["rank"]).otherwise(carry["known"])


@dataclass(frozen=True)
class DenseRank(_Carried):
    """One more than the number of different places in the order that come earlier."""

    reach = 1

    def over(self, window: WindowSpec) -> Column:
        return F.dense_rank().over(window).cast("long")

    def local(self, window: WindowSpec, order: list[Column], own: Column) -> dict[str, Column]:
        return {"rank": F.dense_rank().over(window.orderBy(*order)).cast("long")}

    def total(self, part: dict[str, Column], own: Column, earlier: Column, place: Column) -> dict[str, Column]:
        seen = F.coalesce(F.max(F.when(earlier, part["rank"])), F.lit(0))
        return {"seen": seen, "more": F.max(F.when(own, part["rank"])) - seen}

    def carry(self, total: dict[str, Column], before: WindowSpec, start: Column, copied: Column) -> dict[str, Column]:
        return {"base": F.coalesce(F.sum(total["more"]).over(before), F.lit(0)) - total["seen"]}

    def whole(self, part: dict[str, Column], carry: dict[str, Column], start: Column, copied: Column) -> Column:
        return carry["base"] + part["rank"]


@dataclass(frozen=True)
class NTile(_Ordered):
    """Which of ``n`` parts of the group, as equal as can be and the larger ones first, the row is in."""

    n: int

    def over(self, window: WindowSpec) -> Column:
        return F.ntile(self.n).over(window).cast("long")

    def at(self, place: Column, rows: Column) -> Column:
        """From the place in the group and the group's rows."""
        small, more = F.floor(rows / self.n), rows % self.n
        wide = more * (small + 1)
        # With fewer rows than parts every row is a part: those of ``small`` rows have none.
        later = more + F.floor((place - wide) / F.greatest(small, F.lit(1)))
        return (F.when(place < wide, F.floor(place / (small + 1))).otherwise(later) + 1).cast("long")


def positions(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str | Column],
    name: str = "position",
    block: int | None = 1 << 20,
) -> DataFrame:
    """Number the rows of each group from 1, like ``row_number()``; see :func:`moving`."""
    return moving(df, by, order_by, {}, name, block)


def moving(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str | Column],
    columns: Mapping[str, _Ordered],
    position: str | None = None,
    block: int | None = 1 << 20,
) -> DataFrame:
    """Add window columns by name, and the row number if ``position`` names it.

    Columns are declared as ``Lag``, ``Lead``, ``Rolling``, ``Running``, ``Rank``, ``DenseRank`` or ``NTile``.

    A group of more than ``block`` rows is cut into blocks of that size, each of which also sees as many
    rows of its neighbours as the columns look back or ahead. At most 100,000 groups may be that big; with
    more the call is refused, and a bigger ``block`` is needed. ``block=None`` is for callers who know that
    their groups are small: groups are not counted then and none is cut. Without ``by`` all rows are one group.
    ``order_by`` should end in a key of the group; rows that tie come in any order (and share ranks).

    Groups are counted, and big ones sorted and written, when this is called, not when its result is read.
    ``df`` is read several times, so write one that is costly or not deterministic to the scratch
    folder first (:func:`millrace.scratch.materialize`).
    """
    columns, by = dict(columns), list(by)
    _check(df, columns, position, block)
    taken = [*df.columns, *columns, *([position] if position else [])]
    names = _Names(*(unused(taken, f"__{part}") for part in _Names.__dataclass_fields__))
    rows = df
    if not by:
        rows, by = df.withColumn(names.all, F.lit(0)), [names.all]
    order_by = [_named(c) if isinstance(c, str) else c for c in order_by]

    def plain(some: DataFrame) -> DataFrame:
        window = Window.partitionBy(*map(_named, by)).orderBy(*order_by)
        return some.withColumns(_results(window, columns, position and F.row_number().over(window).cast("long"), position))

    def done(some: DataFrame) -> DataFrame:
        return some.select(*map(_named, taken))

    if block is None:
        return done(plain(rows))
    sizes = rows.groupBy(*map(_named, by)).agg(F.count(F.lit(1)).alias(names.rows))
    big = materialize(sizes.where(F.col(names.rows) > block), "big")
    n_big = big.count()
    if n_big > _MAX_BIG:
        raise ValueError(f"{n_big} groups have more than {block} rows; at most {_MAX_BIG} may: take a bigger block")
    if not n_big:
        return done(plain(rows))
    placed = _placed(_joined(rows, big, by, "left_semi"), big, by, order_by, names)
    small = done(plain(_joined(rows, big, by, "left_anti")))
    blocked = done(_blocked(placed, by, order_by, columns, position, block, names))
    # Totals of totals may be of a wider type than a total.
    kinds = {c.name: c.dataType for c in small.schema if c.dataType.simpleString() != blocked.schema[c.name].dataType.simpleString()}
    return small.unionByName(blocked.withColumns({name: _named(name).cast(kind) for name, kind in kinds.items()}) if kinds else blocked)


@dataclass(frozen=True)
class _Names:
    """Helper columns, named unlike any column of the data or of the result."""

    all: str
    rows: str
    start: str
    mark: str
    part: str
    offset: str
    place: str
    home: str
    block: str
    total: str
    local: str
    carry: str


def _check(df: DataFrame, columns: Mapping[str, _Ordered], position: str | None, block: int | None) -> None:
    for name, column in columns.items():
        if not isinstance(column, _Ordered):
            kinds = ", ".join(kind.__name__ for kind in (Lag, Lead, Rolling, Running, Rank, DenseRank))
            raise TypeError(f"{name}: declare the column as Lag or Rolling, or another of {kinds} or NTile")
        if isinstance(column, (Lag, Lead)) and column.n < 1 or isinstance(column, Rolling) and column.rows < 1:
            raise ValueError(f"{name}: a column looks back or ahead, by one row at least")
        if isinstance(column, NTile) and column.n < 1:
            raise ValueError(f"{name}: one part at least")
        known = _RUNNING.keys() | {"avg"} if isinstance(column, Running) else _HOW
        if isinstance(column, (Rolling, Running)) and column.how not in known:
            raise ValueError(f"{name}: unknown {column.how!r}; expected one of {', '.join(sorted(known))}")
        if block is not None and max(column.reach, column.ahead) > block:
            raise ValueError(f"{name}: reach {max(column.reach, column.ahead)} must not exceed the block of {block} rows")
    if block is not None and block < 1:
        raise ValueError("block must be one row at least")
    results = [*columns, *([position] if position else [])]
    seen = [name.lower() for name in df.columns]
    for name in results:
        if name.lower() in seen:
            raise ValueError(f"The data already has a column {name}")
        seen.append(name.lower())
    odd = [c.name for c in df.schema if "interval" in c.dataType.simpleString()]
    if odd:
        raise ValueError(f"Interval columns cannot be written to the scratch folder: {', '.join(odd)}")


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _results(window: WindowSpec, columns: Mapping[str, _Ordered], number: Column | None, position: str | None):
    found = {name: column.over(window) for name, column in columns.items()}
    return found if position is None else {**found, position: number}


def _placed(rows: DataFrame, big: DataFrame, by: list[str], order_by: list[Column], names: _Names) -> DataFrame:
    """The rows of big groups with their place in the group, from 0.

    The sorted rows are written once, so that places and rows agree even if an executor is lost.
    """
    part = F.shiftright(names.mark, _ID_BITS)
    numbered, tie = with_numbers(rows)
    in_order = numbered.orderBy(*map(_named, by), *order_by, tie).drop(tie)
    ordered = materialize(in_order.withColumn(names.mark, F.monotonically_increasing_id()), "ordered")
    # One row of two numbers per sort partition, and one row per big group: windows over all of
    # them are small. Both are written, so Spark knows their size and broadcasts them if they are small.
    offsets = materialize(
        ordered.groupBy(part.alias(names.part))
        .agg(F.count(F.lit(1)).alias(names.rows))
        .select(names.part, _before(names, F.col(names.part)).alias(names.offset)),
        "offsets",
    )
    total = F.col(names.rows).alias(names.total)
    starts = big.select(*map(_named, by), total, _before(names, *map(_named, by)).alias(names.start))
    starts = materialize(starts, "starts")
    index = F.col(names.offset) + F.col(names.mark).bitwiseAND((1 << _ID_BITS) - 1)
    indexed = ordered.join(offsets, part == F.col(names.part))
    return _joined(indexed, starts, by, "inner").select(
        *map(_named, rows.columns), (index - F.col(names.start)).alias(names.place), names.total
    )


def _before(names: _Names, *order: Column) -> Column:
    """Sum of the counts that come earlier."""
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(names.rows).over(window), F.lit(0))


def _blocked(
    rows: DataFrame,
    by: list[str],
    order_by: list[Column],
    columns: Mapping[str, _Ordered],
    position: str | None,
    block: int,
    names: _Names,
) -> DataFrame:
    place, home, at = F.col(names.place), F.col(names.home), F.col(names.block)
    reach, ahead = (max([0, *(getattr(column, side) for column in columns.values())]) for side in ("reach", "ahead"))
    rows = rows.withColumn(names.home, ((place - place % block) / block).cast("long"))
    places = [home]
    if reach:
        places.append(F.when(place % block >= block - reach, home + 1))
    if ahead:
        places.append(F.when((place % block < ahead) & (home > 0), home - 1))
    # A block after the last one has only rows of the one before; they are not its own, so it gives none.
    copies = F.explode(F.array_compact(F.array(*places))) if len(places) > 1 else home
    rows = rows.withColumn(names.block, copies)
    window, own = Window.partitionBy(*map(_named, by), names.block).orderBy(names.place), at == home
    carried = {name: column for name, column in columns.items() if isinstance(column, _Carried)}
    tiles = {name: column.at(place, F.col(names.total)) for name, column in columns.items() if isinstance(column, NTile)}
    seen = {name: column for name, column in columns.items() if name not in carried and name not in tiles}
    found = rows.withColumns({**_results(window, seen, place + 1, position), **tiles})
    if not carried:
        return found.where(own)

    def parts(some: dict[str, Column], kind: str, name: str) -> dict[str, tuple[str, Column]]:
        """Helper columns of the result ``name``: what they are called, and what they are."""
        return {part: (f"{kind}{list(carried).index(name)}_{part}", value) for part, value in some.items()}

    def flat(made: dict[str, dict[str, tuple[str, Column]]]) -> dict[str, Column]:
        return {called: value for one in made.values() for called, value in one.values()}

    def named(made: dict[str, tuple[str, Column]]) -> dict[str, Column]:
        return {part: F.col(called) for part, (called, _) in made.items()}

    local = {name: parts(column.local(window, order_by, own), names.local, name) for name, column in carried.items()}
    # Written: rows are summed up by block, and then meet what the sums carry into their block.
    found = materialize(found.withColumns(flat(local)), "blocks")
    total = {name: parts(column.total(named(local[name]), own, home < at, place), names.total, name) for name, column in carried.items()}
    sums = found.groupBy(*map(_named, by), at).agg(*[value.alias(called) for called, value in flat(total).items()])
    before = Window.partitionBy(*map(_named, by)).orderBy(names.block).rowsBetween(Window.unboundedPreceding, -1)
    start, copied = at * block, F.when(at > 0, F.lit(reach)).otherwise(F.lit(0))
    carry = {name: parts(column.carry(named(total[name]), before, start, copied), names.carry, name) for name, column in carried.items()}
    sums = sums.select(*map(_named, by), names.block, *[value.alias(called) for called, value in flat(carry).items()])
    sums = materialize(sums, "carried")
    joined = _joined(found.where(own), sums, [*by, names.block], "inner")
    return joined.withColumns({name: column.whole(named(local[name]), named(carry[name]), start, copied) for name, column in carried.items()})


def _joined(rows: DataFrame, few: DataFrame, by: list[str], how: str) -> DataFrame:
    """Join on the group, null being a group, to a frame with one row per big group (or block of one)."""
    own = {c: unused([*rows.columns, *few.columns], f"__few_{i}") for i, c in enumerate(by)}
    renamed = few.select(*[_named(c).alias(own.get(c, c)) for c in few.columns])
    same = reduce(and_, [_named(c).eqNullSafe(_named(own[c])) for c in by])
    return rows.join(renamed, same, how).drop(*own.values())
