"""Configured jobs, reports by name and probes."""

import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace import (
    FileSource,
    JdbcSource,
    PipelineSpec,
    Target,
    probe_sources,
    probe_target,
    read_files,
    read_jdbc,
    run_pipeline,
    run_report,
    spec_from_maps,
    write_files,
)
from millrace.plans import REPORTS, reports
from millrace.plans.etl import shape

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup(action.__name__, "counted")
    try:
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(action.__name__))
        result = action()
        return result, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(action.__name__)) - before)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("into", ["csv", "json", "parquet"])
@pytest.mark.parametrize("source", ["csv", "json", "parquet"])
def test_every_format_to_every_format(spark, tmp_path, source, into):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_files(spark.sql("select 1 as `Order Key`, 2.5D as `Unit-Price` union all select 2, null"), raw, source)
    spec = PipelineSpec(
        FileSource(raw, source),
        Target(out, into),
        "shop",
        sql="select * from raw_orders where `Order Key` > 0",
        view="raw_orders",
        steps=(("Double", "`Unit-Price` * 2"), ("Double", "Double + 1")),
    )
    result = run_pipeline(spark, spec, count_input=True)
    assert (result.rows_in, result.rows_out, result.path) == (2, 2, out)
    back = read_files(spark, out, into)
    assert set(back.columns) == {
        "order_key", "unit_price", "double", "_ingestion_timestamp", "_processing_date", "_source_system",
    }
    assert sorted((r.order_key, r.unit_price, r.double) for r in back.collect()) == [(1, 2.5, 6.0), (2, None, None)]


def test_one_job_reads_the_source_once(spark, tmp_path):
    spec = PipelineSpec(FileSource(ORDERS, "parquet"), Target(str(tmp_path / "t")), "shop")
    source = spec.source.load(spark)  # Spark reads the schema from a footer in a job of its own
    from millrace.plans.etl import deliver

    def write():
        return deliver(shape(source, spec), spec.target)

    result, jobs = jobs_of(spark, write)
    assert (result.rows_out, result.rows_in, jobs) == (1500, None, 1)


def test_filters_and_columns_reach_the_scan(spark):
    spec = PipelineSpec(
        FileSource(ORDERS, "parquet"),
        Target("/nowhere"),
        "shop",
        sql="select o_orderkey from source_data where o_custkey = 7 and o_totalprice > 1000",
    )
    plan = shape(spec.source.load(spark), spec)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,7)" in plan and "GreaterThan(o_totalprice" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_a_bad_spec_fails_before_any_write(spark, tmp_path):
    out = str(tmp_path / "t")
    good = FileSource(ORDERS, "parquet")
    for spec in (
        PipelineSpec(good, Target(out, "orc"), "shop"),
        PipelineSpec(good, Target(out, mode="replace"), "shop"),
        PipelineSpec(good, Target(out), "shop", steps=(("O Orderkey", "1"), ("O_ORDERKEY ", "1"), ("o-orderkey", "2"))),
        PipelineSpec(good, Target(out, run_date="2024-01-01"), "shop", steps=(("execution_date", "1"),)),
        PipelineSpec(good, Target(ORDERS), "shop"),
    ):
        with pytest.raises(ValueError):
            run_pipeline(spark, spec)
    assert not os.path.exists(out)


def test_a_run_date_is_a_partition_that_a_rerun_replaces(spark, tmp_path):
    out = str(tmp_path / "t")
    for day, sql in (("2024-01-01", None), ("2024-01-02", None), ("2024-01-01", "select * from source_data limit 3")):
        run_pipeline(spark, PipelineSpec(FileSource(ORDERS, "parquet"), Target(out, run_date=day), "shop", sql=sql))
    counts = spark.read.parquet(out).groupBy("execution_date").count().collect()
    assert {str(r.execution_date): r["count"] for r in counts} == {"2024-01-01": 3, "2024-01-02": 1500}


@pytest.mark.parametrize("partition_by", [(), ("o_orderstatus",)])
@pytest.mark.parametrize(("sql", "left"), [("false", 0), ("o_orderstatus = 'F'", 493), ("true", 1500)])
def test_a_rerun_replaces_the_whole_day(spark, tmp_path, partition_by, sql, left):
    out = str(tmp_path / "t")
    for day, condition in (("2024-01-01", "true"), ("2024-01-02", "true"), ("2024-01-01", sql)):
        target = Target(out, run_date=day, partition_by=partition_by, verify=True)
        text = f"select * from source_data where {condition}"
        done = run_pipeline(spark, PipelineSpec(FileSource(ORDERS, "parquet"), target, "shop", sql=text))
    assert done.rows_out == left and done.path == out
    counts = spark.read.parquet(out).groupBy("execution_date").count().collect()
    assert {str(r.execution_date): r["count"] for r in counts} == {"2024-01-02": 1500, **({"2024-01-01": left} if left else {})}


def test_modes_look_at_one_day(spark, tmp_path):
    out = str(tmp_path / "t")

    def run(day, mode):
        return run_pipeline(spark, PipelineSpec(FileSource(ORDERS, "parquet"), Target(out, mode=mode, run_date=day), "shop"))

    run("2024-01-01", "error")
    run("2024-01-02", "error")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run("2024-01-01", "error")
    assert run("2024-01-02", "ignore").skipped and not run("2024-01-03", "ignore").skipped
    run("2024-01-01", "append")
    assert spark.read.parquet(out).count() == 4 * 1500
    day = FileSource(f"{out}/execution_date=2024-01-02", "parquet")
    again = PipelineSpec(day, Target(out, run_date="2024-01-02"), "shop", replace_metadata=True)
    with pytest.raises(ValueError, match="Cannot overwrite"):
        run_pipeline(spark, again)
    assert run_pipeline(spark, replace(again, target=Target(out, run_date="2024-01-01"))).rows_out == 1500
    with pytest.raises(ValueError):
        run("yesterday", "append")


def test_jobs_run_side_by_side(spark, tmp_path):
    def run(k):
        sql = f"select o_orderkey, {k} as k from source_data where o_orderkey % 8 = {k}"
        return run_pipeline(spark, PipelineSpec(FileSource(ORDERS, "parquet"), Target(str(tmp_path / str(k))), "shop", sql=sql)).rows_out

    with ThreadPoolExecutor(8) as pool:
        counts = list(pool.map(run, range(8)))
    assert sum(counts) == 1500 and all(counts)
    assert all({r.k for r in spark.read.parquet(str(tmp_path / str(k))).collect()} == {k} for k in range(8))
    assert not [t for t in spark.catalog.listTables() if t.name == "source_data"]


def test_csv_from_maps_can_be_split(spark, tmp_path):
    path = str(tmp_path / "c")
    write_files(spark.range(0, 40000).select("id", F.lit("v" * 200).alias("v")), path, "csv", sort_by=["id"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        maps = {"file_path": path, "schema": "id long, v string"}
        whole, split = (
            spec_from_maps("gcs", {**maps, **more}, {}, {"output_path": "x"}).source.load(spark)
            for more in ({}, {"multi_line": "false"})
        )
        assert split.rdd.getNumPartitions() > 2 * whole.rdd.getNumPartitions()
        assert split.dtypes == whole.dtypes == [("id", "bigint"), ("v", "string")] and split.count() == 40000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fixed_clock(spark, tmp_path):
    out = str(tmp_path / "t")
    clock = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    run_pipeline(spark, PipelineSpec(FileSource(ORDERS, "parquet"), Target(out, "csv"), "shop", clock=clock))
    got = read_files(spark, out, "csv").select("_ingestion_timestamp", "_processing_date").distinct().collect()
    assert [tuple(r) for r in got] == [(clock, clock.date())]


def test_string_maps(spark, tmp_path):
    spec = spec_from_maps(
        "Gcs",
        {"file_path": "/in"},
        {
            "transform_b": "1",
            "sql_query": "select 1",
            "transform_a_transform_b": "2",
            "transform_c": "b + 1",
            "transform_d": "4",
            "transform_a": "5",
        },
        {"output_path": "/out"},
    )
    assert spec.source == FileSource("/in", "csv", True)
    assert spec.target == Target("/out", "parquet", "overwrite")
    assert (spec.sql, spec.view, spec.source_system) == ("select 1", "source_data", "gcs")
    assert [name for name, _ in spec.steps] == ["b", "a_transform_b", "c", "d", "a"]
    assert spec_from_maps("gcs", {"file_path": "/i", "header": "FALSE"}, {}, {"output_path": "/o"}).source.header is False

    asked = []
    spec = spec_from_maps(
        "ORACLE",
        {"project_id": "p", "secret_id": "s", "query": "select 1 from dual"},
        {"temp_view": "v"},
        {"output_path": "/o", "file_format": "csv", "mode": "append"},
        credentials=lambda *names: asked.append(names) or {"url": "jdbc:x", "user": "u", "password": "p"},
        source_system="erp",
    )
    assert asked == [("p", "s")]
    assert spec.source == JdbcSource("jdbc:x", "select 1 from dual", {"user": "u", "password": "p"})
    assert (spec.view, spec.source_system, spec.target.mode) == ("v", "erp", "append")


@pytest.mark.parametrize(
    ("kind", "source", "target", "error"),
    [
        ("s3", {"file_path": "/i"}, {"output_path": "/o"}, ValueError),
        ("gcs", {"file_path": "/i", "header": "yes"}, {"output_path": "/o"}, ValueError),
        ("oracle", {"project_id": "p", "secret_id": "s", "query": "q"}, {"output_path": "/o"}, ValueError),
        ("gcs", {}, {"output_path": "/o"}, KeyError),
        ("gcs", {"file_path": "/i"}, {}, KeyError),
    ],
)
def test_bad_maps(kind, source, target, error):
    with pytest.raises(error):
        spec_from_maps(kind, source, {}, target)


@pytest.fixture(scope="module")
def tables(spark):
    employees = spark.createDataFrame(
        [(1, "Ann", "a"), (2, "Ann", "a"), (3, "Bo", "b"), (4, "Cy", None), (5, "Di", "a"), (5, "Di", "a")],
        "id long, name string, department string",
    )
    sales = spark.createDataFrame(
        [(10, 1, 7, 10.10), (11, 1, 7, 0.20), (12, 3, 8, 5.0), (None, 3, 8, 1.0), (13, None, 8, 99.0), (14, 5, 9, 2.5)],
        "id long, employee_id long, customer_id long, total_amount double",
    ).withColumn("sold_at", F.lit("2024-01-31 10:00:00").cast("timestamp_ntz"))
    return {
        "employees": employees,
        "sales": sales,
        "customers": spark.createDataFrame([(7, "x"), (8, "y"), (6, "y")], "id long, segment string"),
        "members": spark.createDataFrame([(1, "a", 10.0), (2, "a", 5.5), (3, "b", 1.0)], "id long, department string, budget double"),
        "costs": spark.createDataFrame([(1, 4.0), (1, 4.0), (2, 0.5)], "member_id long, amount double"),
        "events": spark.createDataFrame([(1, "click", 2.5), (1, "click", 1.0)], "user_id long, event_type string, value double").withColumn(
            "ts", F.lit("2024-01-31 23:59:59.999999").cast("timestamp_ntz")
        ),
    }


def test_rollup_equals_the_plain_join(spark, tables):
    tables["employees"].createOrReplaceTempView("t_employees")
    tables["sales"].createOrReplaceTempView("t_sales")
    want = spark.sql(
        """select e.name, e.department, count(s.id) as total_sales,
                  cast(sum(cast(s.total_amount as decimal(18,2))) as decimal(38,2)) as total_revenue
           from t_employees e left join t_sales s on e.id = s.employee_id group by e.id, e.name, e.department"""
    )
    got = reports.rep_sales_rollup(tables["employees"], tables["sales"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    spark.catalog.dropTempView("t_employees")
    spark.catalog.dropTempView("t_sales")


def test_ranks(tables):
    got = reports.employee_analytics(tables["employees"], tables["sales"]).collect()
    assert sorted((str(r.department), r.department_rank, r.id) for r in got) == [
        ("None", 1, 4), ("a", 1, 1), ("a", 2, 5), ("a", 3, 2), ("b", 1, 3),
    ]


def test_a_customer_without_sales_and_a_department_without_costs(tables):
    got = {r.id: r for r in reports.customer_analytics(tables["customers"], tables["sales"]).collect()}
    assert (got[6].n_orders, got[6].spend, got[6].first_order) == (0, None, None)
    assert (got[7].n_orders, str(got[7].spend)) == (2, "10.30")
    report = {r.department: r for r in reports.department_report(tables["members"], tables["costs"]).collect()}
    assert tuple(map(str, report["a"][1:])) == ("15.50", "8.50", "7.00")
    assert (str(report["b"].budget), report["b"].cost, report["b"].variance) == ("1.00", None, None)


@pytest.mark.parametrize("name", [*REPORTS, "test-connection"])
def test_every_report_by_name(spark, tables, tmp_path, name):
    out = str(tmp_path / "t")
    result = run_report(name, tables, Target(out), dt.date(2024, 1, 31), "erp")
    back = spark.read.parquet(out)
    assert result.rows_out == back.count() > 0
    assert {"_ingestion_timestamp", "_processing_date", "_source_system", "execution_date"} < set(back.columns)
    assert os.listdir(out).count("execution_date=2024-01-31") == 1
    with pytest.raises(ValueError, match="Unknown report"):
        run_report("custom-analytics", tables, Target(out), dt.date(2024, 1, 31), "erp")


def test_probes_do_not_stop_each_other(spark):
    def broken():
        raise RuntimeError("no\nway")

    got = probe_sources(
        spark,
        {
            "orders": lambda: spark.read.parquet(ORDERS).limit(3),
            "gone": lambda: spark.read.parquet("/nowhere"),
            "broken": broken,
            "late": lambda: spark.range(3).select(F.raise_error(F.lit("late")).alias("x")).where("x is null"),
            "database": lambda: read_jdbc(spark, "jdbc:none:x", "select 1", {"driver": "no.such.Driver"}),
        },
    ).collect()
    assert [(r.source, r.status, r.n) for r in got] == [
        ("orders", "ok", 3), ("gone", "failed", None), ("broken", "failed", None), ("late", "failed", None), ("database", "failed", None),
    ]
    assert got[0].error is None and got[2].error == "RuntimeError: no" and "PATH_NOT_FOUND" in got[1].error
    assert [r.rows is None for r in got] == [False, True, True, True, True]


def test_probes_return_the_rows_they_saw(spark):
    orders = {"orders": lambda: spark.read.parquet(ORDERS).orderBy("o_orderkey"), "none": lambda: spark.range(0)}
    got = {r.source: r for r in probe_sources(spark, orders, limit=2, columns={"orders": ["o_orderkey", "o_orderstatus"]}).collect()}
    first = [json.loads(x) for x in got["orders"].rows]
    assert got["orders"].n == 2 and [list(x) for x in first] == [["o_orderkey", "o_orderstatus"]] * 2
    assert (got["none"].status, got["none"].n, got["none"].rows) == ("ok", 0, [])


def test_a_probe_stops_when_it_has_enough_rows(spark, tmp_path):
    """Every row of a file but the first few raises when it is read; so does a column that is not asked for."""
    late = spark.range(0, 1000, 1, 1).select(
        F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("read on"))).alias("a"), F.raise_error(F.lit("read")).alias("b")
    )
    found = probe_sources(spark, {"late": lambda: late}, limit=3, columns={"late": ["a"]}).first()
    assert (found.status, found.n, found.rows) == ("ok", 3, ['{"a":0}', '{"a":1}', '{"a":2}'])


def test_the_check_covers_tables_and_target(spark, tables, tmp_path):
    out = str(tmp_path / "t")
    run_report("test-connection", tables, Target(out), dt.date(2024, 1, 31), "erp")
    rows = spark.read.parquet(out).collect()
    assert {(r.source, r.status) for r in rows} == {(name, "ok") for name in [*tables, "target"]}
    assert spark.read.parquet(f"{out}/_test").count() == 2


def test_a_target_is_probed_by_writing_to_it(spark, tmp_path):
    path = str(tmp_path / "check")
    for _ in range(2):
        assert tuple(probe_target(spark, path).first())[:4] == (path, "ok", 2, None)
    rows = spark.read.parquet(path).collect()
    assert sorted(r.id for r in rows) == [0, 1] and len({r.run for r in rows}) == 1
    put = tmp_path / "file"
    put.write_text("x")
    assert probe_target(spark, f"{put}/below").first().status == "failed"
    assert probe_target(spark, path, "orc").first().error.startswith("ValueError: Unsupported")


def test_overlap_is_refused_before_the_input_is_counted(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_files(spark.range(3), path)
    spec = PipelineSpec(FileSource(path, "parquet"), Target(path), "shop")
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.count", lambda df: pytest.fail("counted"))
    with pytest.raises(ValueError, match="Cannot overwrite"):
        run_pipeline(spark, spec, count_input=True)
