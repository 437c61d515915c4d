"""As-of and interval joins and first rows per group against plain Python, odd rows and hot keys included."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import asof_join, overlap_join, top_k


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def sides(spark, seed, hot=0.4):
    rng = random.Random(seed)

    def key():
        return 0 if rng.random() < hot else None if rng.random() < 0.1 else rng.randint(1, 12)

    def time():
        return None if rng.random() < 0.05 else rng.randint(0, 150)

    left = [(i, key(), time()) for i in range(500)] + [(7, 0, 30)] * 2
    right = [(f"r{i}", key(), time()) for i in range(300)] + [("r5", 0, 30)] * 2
    return left, right


LEFT, RIGHT = "id long, `k.x` int, `t``l` int", "name string, rk int, rt int"


def matched(left, right, direction, exact, tolerance, how):
    out = Counter()
    for row in left:
        _, k, t = row
        found = [
            r
            for r in right
            if None not in (k, t, r[1], r[2])
            and k == r[1]
            and (r[2] <= t if direction == "backward" else r[2] >= t)
            and (exact or r[2] != t)
        ]
        best = max(found, key=lambda r: (r[2] if direction == "backward" else -r[2], r[0]), default=None)
        if best and tolerance is not None and abs(best[2] - t) > tolerance:
            best = None
        if best or how == "left":
            out[row + (best or (None,) * 3)] += 1
    return out


@pytest.mark.parametrize("block", [10, 97, 1 << 20, None])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_join(spark, block, direction):
    left, right = sides(spark, 1)
    a, b = spark.createDataFrame(left, LEFT).repartition(5), spark.createDataFrame(right, RIGHT).repartition(4)
    for exact, tolerance, how in ((True, None, "left"), (False, 4, "left"), (True, 2, "inner")):
        got = asof_join(a, b, ("t`l", "rt"), [("k.x", "rk")], direction, exact, tolerance, how, ["name"], block)
        assert got.columns == ["id", "k.x", "t`l", "name", "rk", "rt"]
        assert rows_of(got) == matched(left, right, direction, exact, tolerance, how)


def test_asof_join_without_keys_by_timestamps(spark):
    start = dt.datetime(2024, 1, 1)
    left = [(i, start + dt.timedelta(minutes=i)) for i in range(40)]
    right = [(i, start + dt.timedelta(minutes=10 * i, seconds=30)) for i in range(4)]
    a, b = spark.createDataFrame(left, "a long, ta timestamp_ntz"), spark.createDataFrame(right, "b long, tb timestamp_ntz")
    got = asof_join(a, b, ("ta", "tb"), tolerance=dt.timedelta(minutes=5), block=7).select("a", "b")
    want = Counter()
    for i, t in left:
        near = [(u, j) for j, u in right if u <= t and t - u <= dt.timedelta(minutes=5)]
        want[(i, max(near)[1] if near else None)] += 1
    assert rows_of(got) == want


def test_asof_join_of_empty_sides_and_bad_calls(spark):
    a, b = spark.createDataFrame([(1, 1, 1)], LEFT), spark.createDataFrame([], RIGHT)
    assert rows_of(asof_join(a, b, ("t`l", "rt"), [("k.x", "rk")])) == {(1, 1, 1, None, None, None): 1}
    assert asof_join(a.where("false"), b, ("t`l", "rt"), [("k.x", "rk")]).count() == 0
    with pytest.raises(ValueError, match="columns named id"):
        asof_join(a, b.withColumn("ID", F.lit(1)), ("t`l", "rt"))
    with pytest.raises(ValueError, match="backward or forward"):
        asof_join(a, b, ("t`l", "rt"), direction="nearest")


def spans(rng, n, kinds):
    out = []
    for i in range(n):
        start = rng.randint(-3000, 3000)
        length = rng.choice([0, 1, 2, 3, rng.randint(0, 40), rng.randint(0, 1000), 4 ** rng.randint(0, 6), -1])
        out.append((i, rng.choice(kinds), start, start + length))
    out += [(n, kinds[0], None, 5), (n + 1, kinds[0], 5, None), (n + 2, None, 0, 9), out[0], (n + 3, kinds[0], -(1 << 63), (1 << 63) - 1), (n + 4, kinds[0], 0, 1 << 62)]
    return out


def overlaps(left, right, closed):
    out = Counter()
    for a in left:
        for b in right:
            if None in a[1:] or None in b[1:] or a[1] != b[1]:
                continue
            if closed and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and b[2] <= a[3]:
                out[a + b] += 1
            elif not closed and a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3]:
                out[a + b] += 1
    return out


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("kinds", [["a"], ["a", "b", "c"]])
def test_overlap_join(spark, closed, kinds):
    rng = random.Random(len(kinds))
    left, right = spans(rng, 250, kinds), spans(rng, 200, kinds)
    a = spark.createDataFrame(left, "id long, k string, `from.a` long, __left_bin long").repartition(4)
    b = spark.createDataFrame(right, "rid long, rk string, rfrom long, rto long").repartition(3)
    got = overlap_join(a, b, ("from.a", "__left_bin"), ("rfrom", "rto"), [("k", "rk")], closed)
    assert got.columns == [*a.columns, *b.columns]
    assert rows_of(got) == overlaps(left, right, closed)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "int"])
def test_overlap_join_of_other_types(spark, kind, zone):
    rng = random.Random(3)
    left, right = ([(i, "a", (s := rng.randint(0, 2000)), s + rng.randint(0, 50)) for i in range(80)] for _ in range(2))
    unit = {"date": dt.timedelta(days=1)}.get(kind, dt.timedelta(minutes=7, microseconds=1))
    zero = dt.date(2023, 1, 1) if kind == "date" else dt.datetime(2024, 3, 9, tzinfo=dt.timezone.utc if kind == "timestamp" else None)

    def typed(rows):
        return [(i, k, *(x if kind == "int" else zero + x * unit for x in span)) for i, k, *span in rows]

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        a = spark.createDataFrame(typed(left), f"id long, k string, a {kind}, b {kind}")
        b = spark.createDataFrame(typed(right), f"rid long, rk string, c {kind}, d {kind}")
        got = Counter(tuple(r) for r in overlap_join(a, b, ("a", "b"), ("c", "d")).select("id", "rid").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == pairs(left, right)


def pairs(left, right):
    return Counter((a[0], b[0]) for a in left for b in right if a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3])


def test_overlap_join_refuses(spark):
    a = spark.createDataFrame([], "id long, a long, b long")
    with pytest.raises(ValueError, match="columns named id"):
        overlap_join(a, a.select("id", F.col("a").alias("c"), F.col("b").alias("d")), ("a", "b"), ("c", "d"))
    b = spark.createDataFrame([], "rid long, c int, d int")
    with pytest.raises(ValueError, match="different types"):
        overlap_join(a, b, ("a", "b"), ("c", "d"))
    with pytest.raises(TypeError, match="whole numbers"):
        overlap_join(*(x.select(*[F.col(c).cast("string").alias(c) for c in x.columns]) for x in (a, b)), ("a", "b"), ("c", "d"))


def test_a_row_is_copied_by_levels_not_by_length(spark):
    """One span over all of time beside many short ones."""
    short = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") * 1000).alias("b"), (F.col("id") * 1000 + 10).alias("c"))
    long = spark.createDataFrame([(1, 0, 1 << 40), (2, 999_000, 1_000_005)], "d long, e long, f long")
    got = overlap_join(short, long, ("b", "c"), ("e", "f"))
    assert got.groupBy("d").count().orderBy("d").collect() == [(1, 2000), (2, 2)]


@pytest.mark.parametrize("k", [1, 3, 2000])
@pytest.mark.parametrize("by", [["g"], [], ["g", "h.x"]])
def test_top_k(spark, k, by):
    rng = random.Random(5)
    rows = [(i, None if rng.random() < 0.1 else "hot" if rng.random() < 0.5 else f"g{i % 7}", i % 2, None if rng.random() < 0.1 else rng.randint(0, 20)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, g string, `h.x` int, v int").repartition(6)
    got = top_k(df, by, [F.desc_nulls_last("v"), "id"], k, "place")
    groups = {}
    for r in rows:
        groups.setdefault(tuple({"g": r[1], "h.x": r[2]}[c] for c in by), []).append(r)
    want, tied = Counter(), Counter()
    for group in groups.values():
        group.sort(key=lambda r: (r[3] is None, -(r[3] or 0), r[0]))
        values = [(r[3] is None, -(r[3] or 0)) for r in group]
        for n, r in enumerate(group, 1):
            if n <= k:
                want[(*r, n)] += 1
            if (rank := values.index(values[n - 1]) + 1) <= k:
                tied[(*r, rank)] += 1
    assert rows_of(got) == want
    assert rows_of(top_k(df, by, [F.desc_nulls_last("v")], k, "place", ties=True)) == tied


def test_top_k_is_the_same_however_the_rows_lie(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("v"), "id")
    first, again = (rows_of(top_k(df.repartition(n), ["g"], ["v"], 7)) for n in (2, 9))
    assert first == again and first.total() == 21


def test_no_task_gets_a_group_that_holds_all_rows(spark):
    """What is shuffled is a few rows of each task, also where all rows are copies."""
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 1).alias("g"), (F.col("id") % 1).alias("v"))
    plan = top_k(df, ["g"], ["v"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and plan.count(", 5, Partial") == 2
    assert top_k(df, ["g"], ["v"], 5).count() == 5
    with pytest.raises(ValueError):
        top_k(df, ["g"], ["v"], 0)
