"""Reports over employees, customers and sales.

``rep_sales_rollup`` is given by its query. The others are known by name and purpose only; their
definitions are this library's own and stand in the docstrings. One table of sales serves all of them:
``sales(id, employee_id, customer_id, total_amount, sold_at)``; each names the columns that it reads.

Facts are summed per key before they meet a dimension: partial sums fold a hot key on the side of
the map tasks, and the join then moves one row per key.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import cents, total_of, wide
from millrace.operators.ordered import positions
from millrace.scratch import materialize


def rep_sales_rollup(employees: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales and revenue of each employee; employees without sales have count 0 and no revenue.

    ``employees(id, name, department)``, ``sales(id, employee_id, total_amount)``. Two people of
    one name stay two rows. Unordered: sort where it is written.
    """
    return _employee_totals(employees, sales).select("name", "department", "total_sales", "total_revenue")


def employee_analytics(employees: DataFrame, sales: DataFrame) -> DataFrame:
    """The roll-up per employee with the place in the department: most revenue first, then lowest id.

    The totals are written to the scratch folder, so that the sales are read once.
    """
    totals = materialize(_employee_totals(employees, sales), "totals")
    order = [F.desc_nulls_last("total_revenue"), "id", "name"]
    return positions(totals, ["department"], order, "department_rank").withColumn(
        "department_rank", F.col("department_rank").cast("int")
    )


def sales_analytics(sales: DataFrame) -> DataFrame:
    """Per month: sales, revenue and distinct buyers. ``sales(id, customer_id, total_amount, sold_at)``."""
    return sales.groupBy(F.year("sold_at").alias("year"), F.month("sold_at").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        total_of("total_amount").alias("revenue"),
        F.count_distinct("customer_id").alias("buyers"),
    )


def customer_analytics(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Frequency, spend, first and last purchase of each customer, also of those without any.

    ``customers(id, segment)`` with unique ids, ``sales(id, customer_id, total_amount, sold_at)``.
    """
    per_customer = sales.groupBy("customer_id").agg(
        F.count("id").alias("n_orders"),
        total_of("total_amount").alias("spend"),
        F.min("sold_at").alias("first_order"),
        F.max("sold_at").alias("last_order"),
    )
    return customers.join(per_customer, customers.id == per_customer.customer_id, "left").select(
        "id",
        "segment",
        _zero("n_orders").alias("n_orders"),
        "spend",
        "first_order",
        "last_order",
    )


def department_report(members: DataFrame, costs: DataFrame) -> DataFrame:
    """Budget against cost per department.

    ``members(id, department, budget)`` with unique ids, ``costs(member_id, amount)``. Costs are
    summed per member first, so that joining them does not repeat a budget.
    """
    per_member = costs.groupBy("member_id").agg(F.sum(cents("amount")).alias("cost"))
    return (
        members.join(per_member, members.id == per_member.member_id, "left")
        .groupBy("department")
        .agg(total_of("budget").alias("budget"), wide(F.sum("cost")).alias("cost"))
        .withColumn("variance", wide(F.col("budget") - F.col("cost")))
    )


def sample_data_processing(events: DataFrame, day: date) -> DataFrame:
    """Events, distinct users and total value of one day, per type.

    ``events(ts, user_id, event_type, value)``. The day is a range of ``ts``, which Parquet can
    use to skip row groups.
    """
    start = F.lit(day.isoformat()).cast(events.schema["ts"].dataType)
    end = F.lit((day + timedelta(days=1)).isoformat()).cast(events.schema["ts"].dataType)
    return (
        events.where((F.col("ts") >= start) & (F.col("ts") < end))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("user_id").alias("users"),
            total_of("value").alias("total"),
        )
    )


def _employee_totals(employees: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per (id, name, department); repeated employee rows count their sales repeatedly."""
    people = employees.groupBy("id", "name", "department").agg(F.count(F.lit(1)).alias("copies"))
    per_employee = sales.groupBy("employee_id").agg(
        F.count("id").alias("n"), F.sum(cents("total_amount")).alias("amount")
    )
    return people.join(per_employee, people.id == per_employee.employee_id, "left").select(
        "id",
        "name",
        "department",
        (_zero("n") * F.col("copies")).alias("total_sales"),
        wide(F.col("amount") * F.col("copies")).alias("total_revenue"),
    )


def _zero(count: str) -> Column:
    return F.coalesce(F.col(count), F.lit(0))
