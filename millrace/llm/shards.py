"""Sharding by a hypergeometric communication matrix: a uniform shuffle into shards of exact sizes.

Rows are written once, each partition in an order of its own (a sort within the partition by a hash of the row's number). How
many rows each partition sends to each target is drawn before any row moves: the matrix with the given row and
column sums that a uniform random permutation would give. It is drawn by halves: the targets' room is split
between the first and the second half of the partitions by a multivariate hypergeometric draw, and so on
down to single partitions. Then a row's target follows from its place in its partition, rows are exchanged, and each target
orders what it got by another hash. A shard is cut into targets of at most ``CELL`` rows, so that no
task orders a whole shard.

Shards differ by one row at most. Draws are functions of the seed, so a lost task gives the same rows
again. The matrix has partitions times targets entries and is held a row per partition, never as a whole.

Only DataFrame functions are used. Nulls, equal rows and any columns pass through; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import fresh
from millrace.scratch import materialize

CELL = 1 << 22
SEED = 20240607

#: Tries of the rejection draw; it accepts more than half the time, so all fail once in 10**18 or less.
TRIES = 64

#: The low bits of a monotonic id count the rows of a partition.
PLACE_BITS = (1 << 33) - 1

#: Levels of the matrix drawn between two exchanges of its parts.
LEVELS = 5


def uniform(*keys: Column | int) -> Column:
    """A number strictly between 0 and 1 that depends on the keys only."""
    hashed = F.xxhash64(*[k if isinstance(k, Column) else F.lit(k) for k in keys])
    return (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)


def log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n <= 20, F.log(F.factorial(F.greatest(n, F.lit(0)).cast("int")).cast("double"))).otherwise(series)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(good: Column, bad: Column, draws: Column, *keys: Column | int) -> Column:
    """How many of ``draws`` balls out of good + bad are good: a draw by the ratio of uniforms.

    A candidate is floor(a + h (v - 1/2) / u) and stands if u squared is at most its probability relative to the mode's.
    """

    def prepared(x: Column) -> Column:
        good, bad, draws = x["good"], x["bad"], x["draws"]
        total = good + bad
        share = good.cast("double") / F.greatest(total, F.lit(1))
        mean = draws * share
        variance = mean * (1 - share) * (total - draws) / F.greatest(total - 1, F.lit(1))
        least, most = F.greatest(F.lit(0).cast("long"), draws - bad), F.least(draws, good)
        mode = F.floor((draws + 1) * ((good + 1) / (total + 2)))
        return F.struct(
            *(c.alias(n) for n, c in (("good", good), ("bad", bad), ("draws", draws), ("least", least), ("most", most))),
            (mean + 0.5).alias("center"),
            (math.sqrt(8 / math.e) * F.sqrt(variance + 0.5) + (3 - 2 * math.sqrt(3 / math.e))).alias("width"),
            F.least(most, F.greatest(least, mode)).alias("mode"),
        )

    def weight(x: Column, k: Column) -> Column:
        parts = F.array(k, x["good"] - k, x["draws"] - k, x["bad"] - x["draws"] + k)
        return -F.aggregate(parts, F.lit(0.0), lambda total, n: total + log_factorial(n))

    def drawn(x: Column, top: Column) -> Column:
        def candidate(i: Column) -> Column:
            u, v = uniform(*keys, i, 1), uniform(*keys, i, 2)
            return let(u, lambda u: F.struct(u.alias("u"), F.floor(x["center"] + x["width"] * (v - 0.5) / u).alias("k")))

        def stands(c: Column) -> Column:
            inside = (c["k"] >= x["least"]) & (c["k"] <= x["most"])
            return inside & (2 * F.log(c["u"]) <= weight(x, F.when(inside, c["k"]).otherwise(x["mode"])) - top)

        first = F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(TRIES - 1)), candidate), stands), 1)["k"]
        return F.when(x["least"] >= x["most"], x["least"]).otherwise(F.coalesce(first, x["mode"])).cast("long")

    balls = F.struct(good.alias("good"), bad.alias("bad"), draws.alias("draws"))
    return let(balls, lambda x: let(prepared(x), lambda x: let(weight(x, x["mode"]), lambda top: drawn(x, top))))


def split_room(room: Column, draws: Column, *keys: Column | int) -> Column:
    """How many of ``draws`` rows go to each target: a multivariate hypergeometric draw on the room left."""
    zero = F.lit(0).cast("long")
    start = F.struct(draws.alias("draws"), F.aggregate(room, zero, lambda a, x: a + x).alias("rest"), F.array().cast("array<bigint>").alias("out"))

    def step(state: Column, own: Column) -> Column:
        rest = state["rest"] - own
        taken = hypergeometric(own, rest, state["draws"], *keys, F.size(state["out"]))
        return F.struct((state["draws"] - taken).alias("draws"), rest.alias("rest"), F.array_append(state["out"], taken).alias("out"))

    return F.aggregate(room, start, step, lambda state: state["out"])


def matrix(counts: DataFrame, room: Column, seed: int = SEED) -> DataFrame:
    """``part`` and ``sends`` (rows to each target) from a table of part and n; the room's sum is that of n."""
    parts = counts.count()
    nodes = counts.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts")).select(
        F.lit(1).cast("long").alias("node"), "parts", room.alias("room")
    )
    for level in range(math.ceil(math.log2(max(1, parts)))):
        half = F.ceil(F.size("parts") / 2).cast("int")
        whole = F.size("parts") < 2
        ahead = F.slice("parts", 1, F.greatest(F.lit(1), half))
        nodes = nodes.withColumn("ahead", ahead).withColumn(
            "first",
            F.when(whole, F.col("room")).otherwise(
                split_room(F.col("room"), F.aggregate("ahead", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(seed), F.col("node"))
            ),
        )
        one = F.struct((F.col("node") * 2).alias("node"), F.col("ahead").alias("parts"), F.col("first").alias("room"))
        other = F.struct(
            (F.col("node") * 2 + 1).alias("node"),
            F.slice("parts", half + 1, F.greatest(F.lit(1), F.size("parts") - half)).alias("parts"),
            F.zip_with("room", "first", lambda a, b: a - b).alias("room"),
        )
        nodes = nodes.select(F.explode(F.when(whole, F.array(one)).otherwise(F.array(one, other))).alias("x")).select("x.*")
        if level % LEVELS == LEVELS - 1:
            nodes = nodes.repartition("node")
    return nodes.where(F.size("parts") > 0).select(F.get("parts", F.lit(0))["part"].alias("part"), F.col("room").alias("sends"))


def _start(size: Column, cells: int, cell: Column) -> Column:
    """First slot of a cell of a shard of ``size`` rows."""
    return F.floor((cell * size) / F.lit(cells)).cast("long")


def shuffled(df: DataFrame, shards: int, seed: int = SEED, cell: int = CELL) -> DataFrame:
    """``df`` with shard (0 to shards - 1) and slot (0 up, without gaps, in each shard) under names that it does not have yet.

    Names are ``shard`` and ``slot``, with underscores before them where the table has these already.
    """
    part, pos, place, sends, at, shard, slot = fresh(df, "part", "pos", "place", "sends", "cell", "shard", "slot")
    numbered = df.withColumns({part: F.spark_partition_id(), pos: F.monotonically_increasing_id()})
    permuted = numbered.sortWithinPartitions(F.xxhash64(F.lit(seed), F.col(pos)), pos).drop(pos)
    rows = materialize(permuted.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS))), "permuted")

    counts = rows.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    cells = max(1, math.ceil(math.ceil(total / shards) / cell))

    def size(j: Column) -> Column:
        return F.lit(total // shards).cast("long") + (j < total % shards).cast("long")

    def capacity(k: Column) -> Column:
        j, i = F.floor(k / cells), k % cells
        return _start(size(j), cells, i + 1) - _start(size(j), cells, i)

    room = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(shards * cells - 1).cast("long")), capacity)
    drawn = materialize(matrix(counts, room, seed), "matrix").select(F.col("part").alias("from"), F.col("sends").alias(sends))
    (own,) = fresh(rows.select("*", F.lit(0).alias(sends)), "from")
    drawn = drawn.withColumnRenamed("from", own)

    # Targets of a partition lie one after the other in its order: a row's target is the first whose end is beyond its place.
    ends = F.aggregate(
        sends,
        F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("ends")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["ends"], a["sum"] + x).alias("ends")),
        lambda a: a["ends"],
    )
    drawn = drawn.withColumn(sends, ends)
    sent = rows.join(drawn, F.col(part) == F.col(own)).withColumn(at, F.size(F.filter(sends, lambda end: end <= F.col(place))))
    again = Window.partitionBy(at).orderBy(F.xxhash64(F.lit(seed + 1), F.col(part), F.col(place)), part, place)
    j, i = F.floor(F.col(at) / cells), F.col(at) % cells
    return (
        sent.withColumn(shard, j.cast("int"))
        .withColumn(slot, _start(size(j), cells, i) + F.row_number().over(again) - 1)
        .drop(part, place, sends, own, at)
    )
