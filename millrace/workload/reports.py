"""Reports on the test tables: suppliers act as employees, lines as their sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import preview
from millrace.plans import reports
from millrace.plans.etl import Target
from millrace.plans.probes import probe_sources
from millrace.plans.routes import run_report
from millrace.scratch import scratch_path
from millrace.workload.case import Case, money, table

_BIG_RETURN = "l_returnflag = 'R' and l_quantity > 49 and l_extendedprice > 95000"


def _employees(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("department")
    )


def _lines(spark: SparkSession, folder: str, condition: str = "true") -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .where(condition)
        .select(
            F.col("l_orderkey").alias("id"),
            F.col("l_suppkey").alias("employee_id"),
            F.col("l_extendedprice").alias("total_amount"),
        )
    )


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    """One table of sales for all reports: lines with the customer and day of their order."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("sold_at"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("employee_id"),
        "customer_id",
        F.col("l_extendedprice").alias("total_amount"),
        "sold_at",
    )


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "employees": _employees(spark, folder),
        "sales": _sales(spark, folder),
        "customers": _customers(spark, folder),
        "members": _members(spark, folder),
        "costs": _costs(spark, folder),
        "events": table(spark, folder, "events"),
    }


def _routed(name: str, columns: str):
    """A report as a job, run by name on the tables that all reports share, then read back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_path(spark, name)
        run_report(name, _tables(spark, folder), Target(path), date(2024, 1, 15), "erp")
        return spark.read.parquet(path).select(*columns.split(), "_source_system", "execution_date")

    return run


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))


def _members(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("department"), F.col("c_acctbal").alias("budget")
    )


def _costs(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(F.col("customer_id").alias("member_id"), F.col("total_amount").alias("amount"))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("sold_at"),
    )


def rep_sales_rollup(spark, folder):
    return reports.rep_sales_rollup(_employees(spark, folder), _lines(spark, folder))


def rep_returns_rollup(spark, folder):
    """Only big returns count as sales, so that some employees have none."""
    return reports.rep_sales_rollup(_employees(spark, folder), _lines(spark, folder, _BIG_RETURN))


def employee_analytics(spark, folder):
    return reports.employee_analytics(_employees(spark, folder), _lines(spark, folder))


def sales_analytics(spark, folder):
    return reports.sales_analytics(_orders(spark, folder))


def customer_analytics(spark, folder):
    return reports.customer_analytics(_customers(spark, folder), _orders(spark, folder))


def department_report(spark, folder):
    return reports.department_report(_members(spark, folder), _costs(spark, folder))


def sample_data_processing(spark, folder):
    return reports.sample_data_processing(table(spark, folder, "events"), date(2024, 1, 15))


def routed_sales_rollup(spark, folder):
    """The roll-up as a job: report, audit columns, names, dated partition; then read back."""
    path = scratch_path(spark, "rollup")
    tables = {"employees": _employees(spark, folder), "sales": _lines(spark, folder)}
    run_report("oracle-to-gcs", tables, Target(path), date(2024, 1, 1), "erp")
    return spark.read.parquet(path).select(
        "name", "department", "total_sales", "total_revenue", "_source_system", "execution_date"
    )


def routed_test_connection(spark, folder):
    """Every table and the target checked by name; then what the job wrote."""
    path = scratch_path(spark, "check")
    run_report("test-connection", _tables(spark, folder), Target(path), date(2024, 1, 15), "erp")
    return spark.read.parquet(path).select("source", "status", "n", "_source_system", "execution_date")


def probe_preview(spark, folder):
    """The rows that a probe returns: the first of each table in the order of its key, two columns each."""
    keys = {"customer": "c_custkey c_name", "part": "p_partkey p_name", "supplier": "s_suppkey s_name"}
    probes = {name: lambda name=name: table(spark, folder, name).orderBy(keys[name].split()[0]) for name in keys}
    found = probe_sources(spark, probes, limit=3, columns={name: c.split() for name, c in keys.items()})
    rows = found.select("source", F.explode("rows").alias("row"))
    names = {name: c.split() for name, c in keys.items()}
    key = F.coalesce(*[F.get_json_object("row", f"$.{c[0]}") for c in names.values()]).cast("long")
    return rows.select("source", key.alias("key"), F.coalesce(*[F.get_json_object("row", f"$.{c[1]}") for c in names.values()]).alias("name"))


def probe(spark, folder):
    names = {"customers": "customer", "employees": "supplier", "products": "part", "sales": "lineitem", "gone": "none"}
    probes = {source: lambda name=name: table(spark, folder, name) for source, name in names.items()}
    return probe_sources(spark, probes).select("source", "status", "n")


def table_preview(spark, folder):
    return preview(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), 3, ["c_custkey"])



def _rollup(condition: str = "true") -> str:
    return f"""
    select s_name as name, s_nationkey as department, count(l_orderkey) as total_sales,
           {money("l_extendedprice")} as total_revenue
    from supplier left join lineitem on s_suppkey = l_suppkey and {condition}
    group by s_suppkey, s_name, s_nationkey"""


_SALES = "(select * from lineitem join orders on l_orderkey = o_orderkey) as sales"


def _dated(sql: str) -> str:
    return f"select r.*, 'erp' as _source_system, date '2024-01-15' as execution_date from ({sql}) r"


CASES = {
    "rep_sales_rollup": Case(rep_sales_rollup, _rollup()),
    "rep_returns_rollup": Case(rep_returns_rollup, _rollup(_BIG_RETURN)),
    "employee_analytics": Case(
        employee_analytics,
        f"""
    with totals as (
      select s_suppkey as id, s_name as name, s_nationkey as department, count(l_orderkey) as total_sales,
             {money("l_extendedprice")} as total_revenue
      from supplier left join lineitem on s_suppkey = l_suppkey
      group by s_suppkey, s_name, s_nationkey)
    select *, cast(rank() over (partition by department order by total_revenue desc, id) as int) as department_rank
    from totals""",
    ),
    "sales_analytics": Case(
        sales_analytics,
        f"""
    select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, count(*) as n_orders,
           {money("o_totalprice")} as revenue, count(distinct o_custkey) as buyers
    from orders group by 1, 2""",
    ),
    "customer_analytics": Case(
        customer_analytics,
        f"""
    select c_custkey as id, c_mktsegment as segment, count(o_orderkey) as n_orders, {money("o_totalprice")} as spend,
           min(o_orderdate) as first_order, max(o_orderdate) as last_order
    from customer left join orders on c_custkey = o_custkey
    group by c_custkey, c_mktsegment""",
    ),
    "department_report": Case(
        department_report,
        f"""
    with b as (select c_mktsegment as department, {money("c_acctbal")} as budget from customer group by 1),
         c as (select c_mktsegment as department, {money("o_totalprice")} as cost
               from customer join orders on c_custkey = o_custkey group by 1)
    select b.department, b.budget, c.cost, cast(b.budget - c.cost as decimal(38,2)) as variance
    from b left join c on b.department = c.department""",
    ),
    "sample_data_processing": Case(
        sample_data_processing,
        f"""
    select event_type, count(*) as n, count(distinct user_id) as users, {money("value")} as total
    from events where cast(ts as date) = date '2024-01-15' group by event_type""",
    ),
    "routed_sales_rollup": Case(
        routed_sales_rollup,
        f"select r.*, 'erp' as _source_system, date '2024-01-01' as execution_date from ({_rollup()}) r",
    ),
    "probe_sources": Case(
        probe,
        """
    select 'customers' as source, 'ok' as status, least(5, count(*)) as n from customer
    union all select 'employees', 'ok', least(5, count(*)) from supplier
    union all select 'products', 'ok', least(5, count(*)) from part
    union all select 'sales', 'ok', least(5, count(*)) from lineitem
    union all select 'gone', 'failed', null""",
    ),
    "probe_preview": Case(
        probe_preview,
        """
    (select 'customer' as source, c_custkey as key, c_name as name from customer order by c_custkey limit 3)
    union all (select 'part', p_partkey, p_name from part order by p_partkey limit 3)
    union all (select 'supplier', s_suppkey, s_name from supplier order by s_suppkey limit 3)""",
    ),
    "routed_employee_analytics": Case(
        _routed("employee-analytics", "id name department total_sales total_revenue department_rank"),
        _dated(f"""
    with totals as (
      select s_suppkey as id, s_name as name, s_nationkey as department, count(l_orderkey) as total_sales,
             {money("l_extendedprice")} as total_revenue
      from supplier left join {_SALES} on s_suppkey = l_suppkey
      group by s_suppkey, s_name, s_nationkey)
    select *, cast(rank() over (partition by department order by total_revenue desc nulls last, id) as int) as department_rank
    from totals"""),
    ),
    "routed_sales_analytics": Case(
        _routed("sales-analytics", "year month n_orders revenue buyers"),
        _dated(f"""
    select cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, count(*) as n_orders,
           {money("l_extendedprice")} as revenue, count(distinct o_custkey) as buyers
    from {_SALES} group by 1, 2"""),
    ),
    "routed_customer_analytics": Case(
        _routed("customer-analytics", "id segment n_orders spend first_order last_order"),
        _dated(f"""
    select c_custkey as id, c_mktsegment as segment, count(l_orderkey) as n_orders, {money("l_extendedprice")} as spend,
           min(o_orderdate) as first_order, max(o_orderdate) as last_order
    from customer left join {_SALES} on c_custkey = o_custkey
    group by c_custkey, c_mktsegment"""),
    ),
    "routed_department_report": Case(
        _routed("department-report", "department budget cost variance"),
        _dated(f"""
    with b as (select c_mktsegment as department, {money("c_acctbal")} as budget from customer group by 1),
         c as (select c_mktsegment as department, {money("o_totalprice")} as cost
               from customer join orders on c_custkey = o_custkey group by 1)
    select b.department, b.budget, c.cost, cast(b.budget - c.cost as decimal(38,2)) as variance
    from b left join c on b.department = c.department"""),
    ),
    "routed_sample_data_processing": Case(
        _routed("sample-data-processing", "event_type n users total"),
        _dated(f"""
    select event_type, count(*) as n, count(distinct user_id) as users, {money("value")} as total
    from events where cast(ts as date) = date '2024-01-15' group by event_type"""),
    ),
    "routed_test_connection": Case(
        routed_test_connection,
        _dated("""
    select 'employees' as source, 'ok' as status, least(5, count(*)) as n from supplier
    union all select 'sales', 'ok', least(5, count(*)) from lineitem join orders on l_orderkey = o_orderkey
    union all select 'customers', 'ok', least(5, count(*)) from customer
    union all select 'members', 'ok', least(5, count(*)) from customer
    union all select 'costs', 'ok', least(5, count(*)) from orders
    union all select 'events', 'ok', least(5, count(*)) from events
    union all select 'target', 'ok', 2"""),
    ),
    "table_preview": Case(
        table_preview, "select c_custkey, c_name, c_mktsegment from customer order by c_custkey limit 3"
    ),
}
