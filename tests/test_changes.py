"""Differences of tables, checksums of contents, upserts into dated folders and merged sketches."""

import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import merge_sketches, upsert_days, write_files, write_sketches
from millrace.operators import difference
from millrace.operators.contents import checksum
from millrace.paths import path_exists, read_paths
from millrace.sinks import WriteVerificationError
from millrace.sinks import files as sink

SHAPE = "k int, `a.b` string, d decimal(10,2), f double, xs array<int>, s struct<u:int,v:string>, m map<string,int>, t timestamp_ntz"


def nested(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


def row(k, a="x", d=None, f=1.5, xs=(1, None), s=(1, None), m=None, t=None):
    return (k, a, d, f, None if xs is None else list(xs), s, m, t)


def told(df):
    return Counter((str(r.k), r["a.b"], str(r.xs), str(r.s), r.change, r.n_old, r.n_new) for r in df.collect())


def test_difference_counts_copies_and_sees_nulls_within(spark):
    old = [row(1), row(1), row(1), row(2), row(3, None), row(4, xs=(1, None)), row(None), row(5, s=(None, "1")), row(6, m={"a": None}), row(7, xs=None)]
    new = [row(1), row(2, "y"), row(3, None), row(4, xs=(None, 1)), row(None), row(None), row(5, s=(1, None)), row(6, m={}), row(7, xs=()), row(8)]
    got = told(difference(nested(spark, old), nested(spark, new), ["k"]))

    def line(r, change, n_old, n_new):
        return (str(r[0]), r[1], str(r[4]), f"Row(u={r[5][0]!r}, v={r[5][1]!r})", change, n_old, n_new)

    want = [line(old[0], "changed", 3, 1), line(old[3], "changed", 1, 0), line(new[1], "changed", 0, 1), line(row(None), "changed", 1, 2), line(row(8), "added", 0, 1)]
    for was, now in ((5, 3), (7, 6), (8, 7), (9, 8)):
        want += [line(old[was], "changed", 1, 0), line(new[now], "changed", 0, 1)]
    assert got == Counter(want)
    kinds = Counter(r.change for r in difference(nested(spark, old), nested(spark, new)).collect())
    assert kinds == {"removed": 6, "added": 7}


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "v"]])
def test_difference_against_counters(spark, keys):
    rng = random.Random(4)
    old, new = ([(rng.choice([0, 0, 0, None, rng.randint(1, 40)]), rng.choice([None, "a", "b"])) for _ in range(400)] for _ in range(2))
    names = ["k", "v"]
    a, b = (spark.createDataFrame(rows, "k int, v string") for rows in (old, new))
    got = Counter(tuple(r) for r in difference(a, b.select("v", "k"), keys).collect())
    was, now, want = Counter(old), Counter(new), Counter()

    def key(r):
        return tuple(r[names.index(c)] for c in keys)

    shared = {key(r) for r in old} & {key(r) for r in new}
    for r in was | now:
        if was[r] != now[r]:
            change = "changed" if keys and key(r) in shared else "removed" if was[r] > now[r] else "added"
            want[(*r, change, was[r], now[r])] += 1
    assert got == want
    assert difference(a, a, keys).isEmpty() and difference(a.limit(0), a.limit(0), keys).isEmpty()


def test_difference_refuses(spark):
    a = spark.createDataFrame([], "k int, v string")
    with pytest.raises(ValueError, match="other columns or types"):
        difference(a, a.withColumn("v", F.lit(1)))
    with pytest.raises(ValueError, match="already has columns n_old"):
        difference(a.withColumn("N_old", F.lit(1)), a.withColumn("N_old", F.lit(1)))
    with pytest.raises(ValueError, match="No columns x"):
        difference(a, a, ["x"])


def test_checksum_tells_what_counts_do_not(spark):
    rows = [row(i, f"t{i}", Decimal(i)) for i in range(20)] + [row(3)]
    same = checksum(nested(spark, rows))

    def of(some):
        return tuple(nested(spark, some).agg(*same).first())

    base = of(rows)
    assert of(rows[::-1]) == base
    changed = [row(0, "other"), *rows[1:]]
    swapped = [row(0, "t1", Decimal(0)), row(1, "t0", Decimal(1)), *rows[2:]]
    doubled = [rows[1], *rows[1:]]
    nulls = [row(0, "t0", Decimal(0), xs=(None, 1)), *rows[1:]]
    assert len({base, of(changed), of(swapped), of(doubled), of(nulls), of(rows[1:]), of([])}) == 7


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_content_checked_writes(spark, tmp_path, fmt, monkeypatch):
    rows = [(i, None if i % 5 == 0 else f't"{i}\n', i / 7, date(2024, 1, 1 + i % 28)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, t string, f double, d date").withColumn("ts", F.expr("timestamp_ntz'2024-01-01 00:00:00.123456'"))
    path = str(tmp_path / "out")
    assert write_files(df, path, fmt, verify="content").rows == 200
    assert write_files(df, path, fmt, "append", verify="content", sort_by=["id"]).rows == 200
    assert write_files(df.limit(0), path, fmt, "append", verify="content").rows == 0
    assert write_files(df, str(tmp_path / "parts"), fmt, "append", ["d"], verify="content").rows == 200
    read = sink.read_files

    def spoilt(change):
        monkeypatch.setattr(sink, "read_files", lambda *a, **b: change(read(*a, **b)))
        with pytest.raises(WriteVerificationError):
            write_files(df, str(tmp_path / "again"), fmt, verify="content")

    spoilt(lambda x: x.withColumn("f", F.when(F.col("id") == 7, F.lit(0.0)).otherwise(F.col("f"))))
    spoilt(lambda x: x.withColumn("f", F.expr("case id when 7 then 8D/7 when 8 then 1D else f end")))
    spoilt(lambda x: x.where("id <> 9").union(x.where("id = 8")))
    spoilt(lambda x: x.union(x.where("id = 8")))
    spoilt(lambda x: x.withColumn("t", F.when(F.col("id") != 5, F.col("t")).otherwise("")))
    monkeypatch.setattr(sink, "read_files", read)
    monkeypatch.setattr(sink, "_reported", lambda _: None)
    assert write_files(df, path, fmt, verify="content").rows == 200  # what was observed got lost
    with pytest.raises(ValueError, match="verify is"):
        write_files(df, path, fmt, verify="contents")


TABLE = "k int, v string, execution_date string"


def days_of(spark, path):
    found = spark.read.parquet(path).select("k", "v", F.col("execution_date").cast("string"))
    return Counter(tuple(r) for r in found.collect())


@pytest.fixture
def dated(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (2, "b2", "2024-01-02"), (3, "c", "2024-01-03"), (None, "n", "2024-01-04"), (9, "z", "2024-01-05")]
    write_files(spark.createDataFrame(rows, TABLE), path, partition_by=["execution_date"])
    return path, Counter(rows)


def files_of(path, day):
    import glob

    return sorted(glob.glob(f"{path}/execution_date={day}/*"))


def test_upsert_rewrites_the_days_it_touches(spark, dated):
    path, rows = dated
    changes = spark.createDataFrame([(2, "new", "2024-01-03"), (None, "N", "2024-01-04"), (7, "seven", "2024-02-01"), (8, "gone", None)], TABLE)
    untouched = files_of(path, "2024-01-05")
    for _ in range(2):  # a rerun gives the same
        result = upsert_days(changes, path, ["k"], deleted="v = 'gone'")
        want = Counter([(1, "a", "2024-01-01"), (2, "new", "2024-01-03"), (3, "c", "2024-01-03"), (None, "N", "2024-01-04"), (9, "z", "2024-01-05"), (7, "seven", "2024-02-01")])
        assert days_of(spark, path) == want
        assert files_of(path, "2024-01-05") == untouched
    assert result.days == ("2024-01-03", "2024-01-04", "2024-02-01") and result.rows == 4
    assert not path_exists(spark, f"{path}/execution_date=2024-01-02")


def test_upsert_that_only_deletes_and_into_nothing(spark, dated, tmp_path):
    path, rows = dated
    gone = spark.createDataFrame([(9, None, None, True), (3, None, None, True)], TABLE + ", gone boolean")
    result = upsert_days(gone, path, ["k"], deleted="gone")
    assert result.emptied == ("2024-01-03", "2024-01-05") and result.rows == 0
    assert days_of(spark, path) == Counter({r: n for r, n in rows.items() if r[0] not in (9, 3)})
    fresh = str(tmp_path / "fresh")
    put = spark.createDataFrame([(1, "a", "2024-01-01")], TABLE)
    assert upsert_days(put, fresh, ["k"]).rows == 1 and upsert_days(put.limit(0), fresh, ["k"]).rows == 0
    assert days_of(spark, fresh) == {(1, "a", "2024-01-01"): 1}


def test_an_upsert_that_breaks_off_leaves_the_old_days(spark, dated, monkeypatch):
    path, rows = dated
    changes = spark.createDataFrame([(1, "A", "2024-01-02"), (3, "C", "2024-01-01")], TABLE)
    broken = changes.withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        upsert_days(broken, path, ["k"])
    assert days_of(spark, path) == rows

    # Broken off while files are written: some tasks are through, others fail.
    from millrace.plans import upsert

    write = upsert.write_files

    def failing(df, *more, **named):
        bad = df.repartition(4).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
        return write(bad, *more, **named)

    monkeypatch.setattr(upsert, "write_files", failing)
    with pytest.raises(Exception, match="broken"):
        upsert_days(changes, path, ["k"])
    assert days_of(spark, path) == rows
    monkeypatch.undo()
    upsert_days(changes, path, ["k"])
    want = [(2, "b", "2024-01-01"), (3, "C", "2024-01-01"), (1, "A", "2024-01-02"), (2, "b2", "2024-01-02"), (None, "n", "2024-01-04"), (9, "z", "2024-01-05")]
    assert days_of(spark, path) == Counter(want)


def test_upsert_refuses(spark, dated):
    path, rows = dated

    def call(rows, shape=TABLE, keys=("k",)):
        upsert_days(spark.createDataFrame(rows, shape), path, keys)

    for match, bad in {
        "more than once": [([(1, "a", "2024-01-01"), (1, "b", "2024-01-02")],)],
        "rows without execution_date": [([(1, "a", None)],)],
        "no column": [([(1, "a")], "k int, v string"), ([], TABLE, ["x"])],
        "lack columns v": [([(1, "2024-01-01")], "k int, execution_date string")],
        "other types in v": [([(1, 2, "2024-01-01")], "k int, v int, execution_date string")],
        "needs a key": [([], TABLE, [])],
    }.items():
        for args in bad:
            with pytest.raises(ValueError, match=match):
                call(*args)
    assert days_of(spark, path) == rows


def test_a_month_from_sketches_of_days(spark, tmp_path):
    path, facts = str(tmp_path / "sketches"), []
    rng = random.Random(1)
    for day in range(1, 31):
        rows = [(rng.choice(["hot", "hot", "x", None]), rng.randint(0, 30_000), None if rng.random() < 0.1 else rng.gauss(0, 1) ** 3) for _ in range(2000)]
        facts += [(day, *r) for r in rows]
        df = spark.createDataFrame(rows, "g string, u long, v double")
        if day % 2:
            df = df.repartition(5)
        write_sketches(df, path, f"2024-04-{day:02}", ["g"], ["u"], ["v"])
    write_sketches(df, path, "2024-04-30", ["g"], ["u"], ["v"])  # a rerun replaces the day
    write_sketches(df, path, "2024-05-01", ["g"], ["u"], ["v"])

    def check(first, last, by):
        merged = merge_sketches(spark, path, f"2024-04-{first:02}", f"2024-04-{last:02}", by, {"median": 0.5, "p99": 0.99})
        assert read_paths(merged) and all("/sketches" in p for p in read_paths(merged))
        for r in merged.collect():
            own = [f for f in facts if first <= f[0] <= last and (not by or f[1] == r.g)]
            users, values = len({f[2] for f in own}), sorted(f[3] for f in own if f[3] is not None)
            assert r.rows == len(own)
            assert abs(r.u_distinct - users) <= 4 * 0.0082 * users + 1
            for got, rank in ((r.v_median, 0.5), (r.v_p99, 0.99)):
                below = sum(v <= got for v in values) / len(values)
                assert abs(below - rank) <= 0.012
        return merged

    assert check(1, 30, ["g"]).count() == 3
    check(1, 30, [])
    check(5, 7, ["g"])
    assert len(merge_sketches(spark, path, "2024-04-05", "2024-04-07").inputFiles()) >= 3
    empty = merge_sketches(spark, path, "2023-01-01", "2023-12-31").collect()
    assert [tuple(r) for r in empty] == [(0, 0, None)]


def test_sketches_of_values_that_cannot_be_sketched_are_null(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("a", None, float("nan")), ("a", None, None)], "g string, u date, v double")
    write_sketches(df, path, "2024-01-01", ["g"], ["u"], ["v"])
    assert [tuple(r) for r in merge_sketches(spark, path, "2024-01-01", "2024-01-01", ["g"]).collect()] == [("a", 2, 0, None)]
    with pytest.raises(ValueError, match="named like results"):
        write_sketches(df.withColumnRenamed("g", "rows"), path, "2024-01-01", ["rows"])


