"""Writing and reading back, and whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.plans.etl import FileSource, PipelineSpec, Target, run_pipeline, spec_from_maps
from millrace.scratch import scratch_path
from millrace.sinks import write_files
from millrace.sources import read_files
from millrace.workload.case import Case, money, table


def _round_trip(fmt: str, name: str) -> Case:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        source, path = table(spark, folder, name), scratch_path(spark, f"{fmt}-{name}")
        write_files(source, path, fmt)
        return read_files(spark, path, fmt, schema=source.schema)

    return Case(run, f"select * from {name}")


def json_inferred(spark, folder):
    """Types found in the data itself."""
    source, path = table(spark, folder, "conversations"), scratch_path(spark, "json-inferred")
    write_files(source, path, "json")
    return read_files(spark, path, "json").select(*source.columns)


def csv_inferred(spark, folder):
    source, path = table(spark, folder, "customer"), scratch_path(spark, "csv-inferred")
    write_files(source, path, "csv")
    return read_files(spark, path, "csv").withColumn("c_custkey", F.col("c_custkey").cast("long"))


def verified_write(spark, folder):
    source, path = table(spark, folder, "lineitem"), scratch_path(spark, "verified")
    done = write_files(source, path, "parquet", verify=True)
    found = read_files(spark, path, "parquet").agg(F.count(F.lit(1)).alias("found"))
    return found.select(F.lit(done.rows).cast("long").alias("written"), "found")


def sorted_write(spark, folder):
    """Highest price first across all files; rows of equal price may lie in any order.

    Beside the rows: whether each is in order within its file, and its file among the others.
    """
    path = scratch_path(spark, "sorted")
    write_files(table(spark, folder, "orders"), path, sort_by=[F.desc("o_totalprice")])
    rows = read_files(spark, path, "parquet").select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    files = rows.groupBy("file").agg(F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"))
    after = Window.orderBy(F.desc("most"), F.desc("least"))  # one row per file
    files = files.select("file", (F.coalesce(F.lag("least").over(after) >= F.col("most"), F.lit(True))).alias("files_in_order"))
    within = Window.partitionBy("file").orderBy("place")
    in_order = F.coalesce(F.lag("o_totalprice").over(within) >= F.col("o_totalprice"), F.lit(True))
    return rows.withColumn("in_order", in_order).join(files, "file").drop("file", "place")


def save_modes(spark, folder):
    """Overwrite, append the same again, then ignore: every order is there twice."""
    source, path = table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), scratch_path(spark, "modes")
    write_files(source, path, mode="overwrite")
    write_files(source, path, mode="append", verify=True)
    write_files(source, path, mode="ignore")
    return read_files(spark, path, "parquet")


def dated_partitions(spark, folder):
    """Two days are written, the first once more with other rows; only that day is replaced."""
    orders, path = table(spark, folder, "orders"), scratch_path(spark, "dated")
    for day, status in [("2024-01-01", "F"), ("2024-01-02", "P"), ("2024-01-01", "O")]:
        rows = orders.where(F.col("o_orderstatus") == status).withColumn("execution_date", F.lit(day).cast("date"))
        write_files(rows, path, partition_by=["execution_date"])
    return read_files(spark, path, "parquet")


def _rerun(spark, path, orders, day, sql, partition_by=()):
    spec = PipelineSpec(
        source=orders,
        target=Target(path, run_date=day, partition_by=partition_by),
        source_system="shop",
        sql=sql,
        clock=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
    )
    return run_pipeline(spark, spec)


def dated_rerun(spark, folder):
    """Two days with all orders; the first is run once more and finds nothing, so nothing of it stays."""
    path, orders = scratch_path(spark, "rerun"), FileSource(f"{folder}/orders.parquet", "parquet")
    for day, sql in [("2024-01-01", "true"), ("2024-01-02", "true"), ("2024-01-01", "false")]:
        _rerun(spark, path, orders, day, f"select * from source_data where {sql}")
    return read_files(spark, path, "parquet").select("o_orderkey", "o_orderstatus", "execution_date")


def dated_rerun_partitioned(spark, folder):
    """The same with folders per status: the second run of the day has one status only, and the others go."""
    path, orders = scratch_path(spark, "rerun"), FileSource(f"{folder}/orders.parquet", "parquet")
    for day, sql in [("2024-01-01", "true"), ("2024-01-02", "true"), ("2024-01-01", "o_orderstatus = 'F'")]:
        _rerun(spark, path, orders, day, f"select * from source_data where {sql}", ("o_orderstatus",))
    return read_files(spark, path, "parquet").select("o_orderkey", "o_orderstatus", "execution_date")


def csv_split_etl(spark, folder):
    """A configured job on CSV that many tasks read: ``multi_line`` off and a schema, both from the map."""
    source, path, out = table(spark, folder, "lineitem"), scratch_path(spark, "lines"), scratch_path(spark, "out")
    write_files(source, path, "csv")
    spec = spec_from_maps(
        "gcs",
        {"file_path": path, "multi_line": "false", "schema": ", ".join(f"{n} {t}" for n, t in source.dtypes)},
        {"sql_query": "select l_returnflag, l_orderkey, l_linenumber, l_quantity from source_data"},
        {"output_path": out},
        source_system="shop",
    )
    run_pipeline(spark, spec)
    return read_files(spark, out, "parquet").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity", "_source_system")


def rebalanced_partitions(spark, folder):
    path = scratch_path(spark, "rebalanced")
    write_files(table(spark, folder, "lineitem"), path, partition_by=["l_returnflag"], rebalance=True)
    return read_files(spark, path, "parquet")


def run_etl(spark, folder):
    path = scratch_path(spark, "etl")
    spec = PipelineSpec(
        source=FileSource(f"{folder}/orders.parquet", "parquet"),
        target=Target(path),
        source_system="shop",
        sql="select o_orderpriority as `Order Priority`, count(*) as n from source_data group by o_orderpriority",
        steps=(("n2", "n * 2"), ("n3", "n2 + 1")),
    )
    run_pipeline(spark, spec)
    return spark.read.parquet(path).select("order_priority", "n", "n2", "n3", "_source_system")


def file_to_file_etl(spark, folder):
    """CSV in, JSON out, from string maps."""
    raw, path = scratch_path(spark, "raw"), scratch_path(spark, "shaped")
    write_files(table(spark, folder, "customer"), raw, "csv")
    spec = spec_from_maps(
        "GCS",
        {"file_path": raw, "file_format": "CSV", "header": "TRUE"},
        {
            "sql_query": "select c_custkey as `Customer-Key`, c_acctbal, c_mktsegment from batch where c_acctbal > 0",
            "temp_view": "batch",
            "transform_c_mktsegment": "lower(c_mktsegment)",
            "transform_tag": "concat(c_mktsegment, '-', `Customer-Key`)",
        },
        {"output_path": path, "file_format": "json"},
    )
    run_pipeline(spark, spec)
    return spark.read.schema(
        "customer_key long, c_acctbal double, c_mktsegment string, tag string, _source_system string"
    ).json(path)


def transform_etl(spark, folder):
    """Exact revenue per customer and day as a dated, sorted target; input and output are counted."""
    path = scratch_path(spark, "daily")
    spec = PipelineSpec(
        source=FileSource(f"{folder}/orders.parquet", "parquet"),
        target=Target(path, run_date="2024-06-09", sort_by=("o_custkey",)),
        source_system="shop",
        sql=f"""
          select o_custkey, cast(o_orderdate as date) as day, {money("o_totalprice")} as revenue
          from source_data group by 1, 2""",
    )
    result = run_pipeline(spark, spec, count_input=True)
    return spark.read.parquet(path).select(
        "o_custkey",
        "day",
        "revenue",
        "execution_date",
        F.lit(result.rows_in).cast("long").alias("rows_in"),
        F.lit(result.rows_out).cast("long").alias("rows_out"),
    )


CASES = {
    **{
        f"{fmt}_roundtrip_{name}": _round_trip(fmt, name)
        for fmt, names in {
            "csv": ("orders", "documents", "events", "pages"),
            "json": ("orders", "documents", "events", "embeddings"),
            "parquet": ("lineitem", "documents"),
        }.items()
        for name in names
    },
    "json_inferred": Case(json_inferred, "select * from conversations"),
    "csv_inferred": Case(csv_inferred, "select * from customer"),
    "verified_write": Case(verified_write, "select count(*) as written, count(*) as found from lineitem"),
    "sorted_write": Case(sorted_write, "select *, true as in_order, true as files_in_order from orders"),
    "dated_rerun": Case(
        dated_rerun, "select o_orderkey, o_orderstatus, date '2024-01-02' as execution_date from orders"
    ),
    "dated_rerun_partitioned": Case(
        dated_rerun_partitioned,
        """
    select o_orderkey, o_orderstatus, date '2024-01-02' as execution_date from orders
    union all select o_orderkey, o_orderstatus, date '2024-01-01' from orders where o_orderstatus = 'F'""",
    ),
    "csv_split_etl": Case(
        csv_split_etl,
        "select l_returnflag, l_orderkey, l_linenumber, l_quantity, 'shop' as _source_system from lineitem",
    ),
    "save_modes": Case(
        save_modes,
        "select o_orderkey, o_totalprice from orders union all select o_orderkey, o_totalprice from orders",
    ),
    "dated_partitions": Case(
        dated_partitions,
        """
    select *, case o_orderstatus when 'O' then date '2024-01-01' else date '2024-01-02' end as execution_date
    from orders where o_orderstatus in ('O', 'P')""",
    ),
    "rebalanced_partitions": Case(rebalanced_partitions, "select * from lineitem"),
    "run_etl": Case(
        run_etl,
        """
    select o_orderpriority as order_priority, count(*) as n, count(*) * 2 as n2, count(*) * 2 + 1 as n3,
           'shop' as _source_system
    from orders group by o_orderpriority""",
    ),
    "file_to_file_etl": Case(
        file_to_file_etl,
        """
    select c_custkey as customer_key, c_acctbal, lower(c_mktsegment) as c_mktsegment,
           concat(lower(c_mktsegment), '-', c_custkey) as tag, 'gcs' as _source_system
    from customer where c_acctbal > 0""",
    ),
    "transform_etl": Case(
        transform_etl,
        f"""
    with days as (
      select o_custkey, cast(o_orderdate as date) as day, {money("o_totalprice")} as revenue from orders group by 1, 2)
    select *, date '2024-06-09' as execution_date, (select count(*) from orders) as rows_in,
           (select count(*) from days) as rows_out
    from days""",
    ),
}
