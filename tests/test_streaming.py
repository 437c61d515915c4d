"""Jobs and sessions on streams of files: what is killed and started again gives what one run gives."""

import glob
import os
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace import FileSource, PipelineSpec, Target, read_files, run_pipeline
from millrace.streaming import batch_sessions, run_stream, split_late, stream_sessions


@pytest.fixture
def folder(spark, tmp_path):
    """Five files of orders."""
    path = str(tmp_path / "in")
    for k in range(5):
        rows = spark.range(k * 100, k * 100 + 100, 1, 1).select("id", (F.col("id") % 7).alias("Group No"), F.concat(F.lit("t,\n"), "id").alias("text"))
        rows.write.mode("append").option("escape", '"').csv(path, header=True)
    return path


SCHEMA = "id long, `Group No` long, text string"


def spec(path, target, fmt="parquet", sql="select * from source_data where id % 3 <> 0", run_date="2024-05-01", **more):
    source = FileSource(path, "csv", schema=SCHEMA)
    return PipelineSpec(source, Target(target, fmt, "append", run_date=run_date, **more), "shop", sql, steps=(("doubled", "id * 2"),))


def table(spark, path, fmt="parquet"):
    schema = None if fmt == "parquet" else "id long, group_no long, text string, doubled long"
    found = read_files(spark, path, fmt, schema=schema)
    return Counter(tuple(r) for r in found.select("id", "group_no", "text", "doubled").collect())


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_a_stream_in_batches_gives_the_batch_result(spark, folder, tmp_path, fmt):
    target, check = str(tmp_path / "out"), str(tmp_path / "check")
    result = run_stream(spark, spec(folder, target, fmt), check, files_per_batch=2)
    assert (result.batches, result.rows_in) == (3, 500)
    whole = str(tmp_path / "whole")
    run_pipeline(spark, spec(folder, whole, fmt))
    assert table(spark, target, fmt) == table(spark, whole, fmt) and table(spark, target, fmt).total() == 333
    assert os.listdir(f"{target}/execution_date=2024-05-01")
    assert run_stream(spark, spec(folder, target, fmt), check).rows_in == 0  # nothing new
    spark.createDataFrame([(1000, 1, "new")], SCHEMA).write.mode("append").csv(folder, header=True)
    assert run_stream(spark, spec(folder, target, fmt, run_date="2024-05-02"), check).rows_in == 1
    assert table(spark, target, fmt).total() == 334 and os.listdir(f"{target}/execution_date=2024-05-02")


def test_a_killed_run_is_taken_up_again(spark, folder, tmp_path):
    target, check = str(tmp_path / "out"), str(tmp_path / "check")
    broken = "select if(id = 250, raise_error('broken'), id) as id, `Group No`, text from source_data where id % 3 <> 0"
    with pytest.raises(Exception, match="broken"):
        run_stream(spark, spec(folder, target, sql=broken), check, files_per_batch=1)
    assert 0 < table(spark, target).total() < 333
    run_stream(spark, spec(folder, target), check, files_per_batch=1)
    whole = str(tmp_path / "whole")
    run_pipeline(spark, spec(folder, whole))
    assert table(spark, target) == table(spark, whole)
    # Killed after a batch was written, before the checkpoint knew: it is run again, on another day, and counts once.
    commits = sorted(glob.glob(f"{check}/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))
    for file in (commits[-1], os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")):
        if os.path.exists(file):
            os.remove(file)
    run_stream(spark, spec(folder, target, run_date="2024-06-09"), check, files_per_batch=1)
    assert table(spark, target) == table(spark, whole)


def test_what_a_stream_cannot_do_is_refused(spark, folder, tmp_path):
    target, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run(some):
        run_stream(spark, some, check)

    for bad in (dict(sort_by=("id",)), dict(rebalance=True), dict(verify=True)):
        with pytest.raises(ValueError, match="appends"):
            run(spec(folder, target, **bad))
    with pytest.raises(ValueError, match="what it writes"):
        run(spec(folder, folder + "/below"))
    with pytest.raises(ValueError, match="needs a schema"):
        run(PipelineSpec(FileSource(folder, "csv"), Target(target, mode="append"), "shop"))
    with pytest.raises(ValueError, match="one path"):
        run(PipelineSpec(FileSource([folder], "csv", schema=SCHEMA), Target(target, mode="append"), "shop"))
    with pytest.raises(Exception, match="(?i)aggregat"):
        run(spec(folder, target, sql="select count(*) as id, 1 as `Group No`, '' as text from source_data"))


START = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENTS = "id long, user string, at timestamp, v long"


def events(rng, n, users="abc"):
    return [(i, rng.choice([*users, None]), START + timedelta(seconds=i * 20 + rng.randint(-300, 300)), i % 9) for i in range(n)]


def put(spark, path, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out, files=1):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    return stream_sessions(stream, f"{out}/tables", f"{out}/check", ["user"], "at", "90 seconds", "10 minutes", ["v"])


def sessions_of(rows, gap=90):
    """Plain Python: (user, start, end, rows, v)."""
    out, by = Counter(), {}
    for _, user, at, v in rows:
        if at is not None:
            by.setdefault(user, []).append((at, v))
    for user, own in by.items():
        own.sort(key=lambda x: x[0])
        groups = []
        for at, v in own:
            if groups and at <= groups[-1][-1][0] + timedelta(seconds=gap):
                groups[-1].append((at, v))
            else:
                groups.append([(at, v)])
        for g in groups:
            out[(user, g[0][0], g[-1][0] + timedelta(seconds=gap), len(g), sum(v for _, v in g))] += 1
    return out


def found(df):
    rows = df.select("user", F.unix_micros("session_start"), F.unix_micros("session_end"), "rows", "v").collect()
    return Counter((r[0], *(START + timedelta(microseconds=x - START.timestamp() * 1e6) for x in r[1:3]), r[3], r[4]) for r in rows)


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sessions_of_a_stream_and_its_late_rows(spark, tmp_path, few_partitions):
    rng = random.Random(3)
    path, out = str(tmp_path / "in"), str(tmp_path)
    rows = events(rng, 400)
    late = [(1000 + k, "a", START + timedelta(seconds=60 * k), 5) for k in range(3)] + [(1010, "b", None, 1)]
    put(spark, path, rows[:150])
    put(spark, path, rows[150:300])
    first = run(spark, path, out)
    assert first["events"].rows_in == 300
    put(spark, path, rows[300:] + late)  # the watermark is beyond them by then
    run(spark, path, out)
    split = spark.read.parquet(f"{out}/tables/events")
    assert sorted(r.id for r in split.where("late = 'true'").collect()) == [1000, 1001, 1002, 1010]
    assert Counter(r.id for r in split.collect()) == Counter(r[0] for r in rows + late)  # nothing is lost
    mark = max(r[2] for r in rows) - timedelta(minutes=10)
    want = {s: n for s, n in sessions_of(rows).items() if s[2] <= mark}
    assert found(spark.read.parquet(f"{out}/tables/sessions")) == want and len(want) > 30
    # What was still open comes when the stream goes on.
    put(spark, path, [(2000, "z", START + timedelta(days=2), 0)])
    run(spark, path, out)
    assert found(spark.read.parquet(f"{out}/tables/sessions")) == sessions_of(rows)
    kept = split.where("late = 'false'")
    assert found(batch_sessions(kept, ["user"], "at", "90 seconds", ["v"])) == sessions_of(rows)


def test_a_killed_run_of_sessions_is_taken_up_again(spark, tmp_path, few_partitions):
    rng = random.Random(5)
    path, out = str(tmp_path / "in"), str(tmp_path)
    rows = events(rng, 200)
    put(spark, path, rows[:100])
    put(spark, path, rows[100:])
    run(spark, path, out)
    before = found(spark.read.parquet(f"{out}/tables/sessions"))
    for part in ("events", "sessions"):
        commits = sorted(glob.glob(f"{out}/check/{part}/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))
        os.remove(commits[-1])
        crc = os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    run(spark, path, out)
    assert found(spark.read.parquet(f"{out}/tables/sessions")) == before
    assert spark.read.parquet(f"{out}/tables/events").count() == 200


def test_rows_of_any_type_are_split_unchanged(spark, tmp_path):
    shape = "l long, i int, f double, b binary, d decimal(20,3), t timestamp, n timestamp_ntz, day date, xs array<struct<u:long,w:timestamp>>, m map<string,double>, at timestamp"
    text = (
        "select 9007199254740993L l, null i, double('NaN') f, X'00ff' b, 1.5BD d, timestamp'1580-01-01 00:00:00.000001Z' t, "
        "timestamp_ntz'9999-12-31 23:59:59.999999' n, date'0099-01-01' day, "
        "array(null, named_struct('u', 9007199254740993L, 'w', timestamp'2024-01-01 00:00:00.123456Z')) xs, map('a', null, 'b', 0.1D) m, timestamp'2024-01-01 00:00:00.5Z' at"
        " union all select null, 7, null, null, null, null, null, null, null, null, null"
    )
    path = str(tmp_path / "in")
    spark.sql(f"select cast(l as long) l, cast(i as int) i, f, b, cast(d as decimal(20,3)) d, t, n, day, xs, m, at from ({text})").write.parquet(path)
    split = split_late(spark.readStream.schema(shape).parquet(path), "at", "1 minute")
    split.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    as_text = [F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), F.hex("b"), F.unix_micros("t")]
    assert Counter(map(tuple, out.drop("late").select(*as_text).collect())) == Counter(map(tuple, spark.read.schema(shape).parquet(path).select(*as_text).collect()))
    assert sorted((r.i is None, r.late) for r in out.collect()) == [(False, True), (True, False)]


def test_split_late_refuses(spark, tmp_path):
    stream = spark.readStream.schema(EVENTS + ", Late int").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="already has a column"):
        split_late(stream, "at", "1 minute")
    with pytest.raises(TypeError, match="timestamp"):
        split_late(stream.drop("Late").withColumn("at", F.col("at").cast("string")), "at", "1 minute")
