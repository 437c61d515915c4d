"""Column steps, audit columns and SQL text."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException, ArithmeticException, ParseException
from pyspark.sql import functions as F

from millrace.operators import add_metadata, apply_transformations, preview, sql_transform, standardize


def test_steps_see_earlier_steps(spark):
    df = spark.sql("select 1 as a, 5 as b")
    got = apply_transformations(df, [("a", "a + 1"), ("c", "a * 10"), ("A", "a + c"), ("d", "b"), ("b", "d + 1")])
    assert got.columns == ["A", "b", "c", "d"]
    assert tuple(got.first()) == (22, 6, 20, 5)


def test_what_a_step_may_hold(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "z")], "id int, t string")
    assert apply_transformations(df, [("w", "explode(split(t, ' '))")]).count() == 3
    assert [r.n for r in apply_transformations(df, [("n", "row_number() over (order by id)")]).orderBy("id").collect()] == [1, 2]
    assert {r.m for r in apply_transformations(df, [("m", "(select max(x) from values (1), (7) t(x))")]).collect()} == {7}
    with pytest.raises(AnalysisException):
        apply_transformations(df, [("s", "sum(id)")])
    with pytest.raises(ArithmeticException):
        apply_transformations(df, [("q", "1 / (id - id)")]).collect()


def test_steps_become_one_projection(spark):
    df = spark.range(10)
    got = apply_transformations(df, [(f"c{i}", f"id + {i}") for i in range(20)])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Project") == 1


def test_audit_columns(spark):
    got = add_metadata(spark.range(3), "erp")
    assert got.columns == ["id", "_ingestion_timestamp", "_processing_date", "_source_system"]
    assert [(f.dataType.simpleString(), f.nullable) for f in got.schema.fields[1:]] == [
        ("timestamp", False),
        ("date", False),
        ("string", False),
    ]
    assert got.select("_ingestion_timestamp").distinct().count() == 1
    fixed = add_metadata(spark.range(1), "erp", dt.datetime(2024, 1, 2, 3, 4, 5)).first()
    assert (fixed._ingestion_timestamp, fixed._processing_date) == (dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2))


def test_audit_columns_do_not_hide_data(spark):
    df = spark.sql("select 'mine' as _Source_System")
    with pytest.raises(ValueError, match="_source_system"):
        add_metadata(df, "erp")
    assert add_metadata(df, "erp", replace_metadata=True).first()._source_system == "erp"
    with pytest.raises(ValueError, match="equal"):
        standardize(spark.sql("select 1 as ` ingestion timestamp`"), "erp")


def test_sql_view_lives_only_for_the_analysis(spark):
    got = sql_transform(spark.range(5), "select sum(id) as s from source_data;")
    assert not spark.catalog.tableExists("source_data")
    assert got.first().s == 10
    with pytest.raises(ParseException):
        sql_transform(spark.range(5), "select 1; select 2")
    assert not spark.catalog.tableExists("source_data")
    with pytest.raises(AnalysisException):
        sql_transform(spark.range(5), "select 1", view="a.b")


def test_sql_refuses_to_shadow(spark):
    spark.range(1).createTempView("taken")
    try:
        with pytest.raises(ValueError, match="taken"):
            sql_transform(spark.range(5), "select * from taken", view="taken")
        with pytest.raises(ValueError, match="taken"):
            sql_transform(spark.range(5), "select 1", tables={"taken": spark.range(2)})
        assert spark.table("taken").count() == 1
        assert not spark.catalog.tableExists("source_data")
        assert sql_transform(spark.range(5), "select count(*) as n from source_data, taken").first().n == 5
    finally:
        spark.catalog.dropTempView("taken")


def test_sql_keeps_the_callers_cache(spark):
    df = spark.range(50).withColumn("v", F.col("id") * 3).cache()
    df.count()
    got = sql_transform(df, "select sum(v) as s from source_data")
    assert df.storageLevel.useMemory
    assert "InMemoryTableScan" in got._jdf.queryExecution().executedPlan().toString()
    df.unpersist()


def test_sql_uses_the_session_of_the_frame(spark):
    other = spark.newSession()
    assert sql_transform(other.range(4), "select max(id) as m from source_data").first().m == 3


def test_sql_filter_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    got = sql_transform(orders, "select o_orderkey from source_data where o_totalprice > 100000")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_preview(spark):
    assert [r.id for r in preview(spark.range(100), 3, [F.desc("id")]).collect()] == [99, 98, 97]
    assert preview(spark.range(2), 5).count() == 2
    assert "TakeOrderedAndProject" in preview(spark.range(100), 3, ["id"])._jdf.queryExecution().executedPlan().toString()


def test_row_wise_operators_accept_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)
    chosen = sql_transform(stream, "select event_id, value from source_data where value is not null")
    shaped = standardize(apply_transformations(chosen, [("Twice It", "value * 2")]), "clicks")
    query = (
        shaped.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "state"))
        .start(str(tmp_path / "out"), format="parquet")
    )
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).where("twice_it = value * 2").count() == 1000
