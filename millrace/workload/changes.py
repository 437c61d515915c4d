"""Differences of tables, changes into dated folders, checked contents, and sketches merged over days."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import difference
from millrace.plans.sketches import merge_sketches, sketches
from millrace.plans.upsert import upsert_days
from millrace.scratch import scratch_path
from millrace.sinks import write_files
from millrace.sources import read_files
from millrace.workload.case import Case, table


def differing_rows(spark, folder):
    """Pairs of user and type among all events and, twice, among the dearer ones."""
    events = table(spark, folder, "events")
    old = events.select("user_id", "event_type")
    dear = events.where("value > 30").select("user_id", "event_type")
    return difference(old, dear.unionByName(dear))


def differing_customers(spark, folder):
    """Customers as they are, and after those in debt have gone, one segment is renamed and suppliers have come."""
    columns = ["key", "nation", "balance", "segment"]
    old = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", F.struct("c_mktsegment").alias("segment")).toDF(*columns)
    renamed = F.when(F.col("segment.c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("segment.c_mktsegment"))
    suppliers = table(spark, folder, "supplier").select(-F.col("s_suppkey") - 1, "s_nationkey", "s_acctbal", F.struct(F.lit("S").alias("c_mktsegment"))).toDF(*columns)
    new = old.where("balance >= 0").withColumn("segment", F.struct(renamed.alias("c_mktsegment"))).unionByName(suppliers)
    found = difference(old, new, ["key"])
    return found.withColumn("segment", F.col("segment.c_mktsegment"))


def changed_days(spark, folder):
    """Errors move to the next day with twice their value, signups of January's second half go, and a new event comes per user."""
    path, events = scratch_path(spark, "days"), table(spark, folder, "events")
    day = F.col("ts").cast("date")
    own = events.select("event_id", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"), day.alias("day"))
    write_files(own, path, partition_by=["day"])
    errors = own.where("event_type = 'error'").select(
        "event_id", "user_id", "event_type", (F.col("value") * 2).cast("decimal(18,2)").alias("value"), F.date_add("day", 1).alias("day")
    )
    signups = own.where("event_type = 'signup' and day > date '2024-01-15'")
    fresh = own.groupBy("user_id").agg(F.max("event_id").alias("last")).select(
        (-F.col("last") - 1).alias("event_id"), "user_id", F.lit("new").alias("event_type"), F.lit(None).cast("decimal(18,2)").alias("value"), F.lit("2024-02-10").cast("date").alias("day")
    )
    changes = errors.unionByName(signups).unionByName(fresh)
    for _ in range(2):  # again, as after a run that broke off
        upsert_days(changes, path, ["event_id"], "day", deleted="event_type = 'signup'")
    return read_files(spark, path, "parquet", schema=own.schema)


def checked_contents(spark, folder):
    """A customer's orders as nested rows, written in two appends and compared cell by cell."""
    orders = table(spark, folder, "orders")
    nested = orders.select("o_orderkey", F.struct("o_custkey", F.array("o_orderstatus", F.lit(None).cast("string")).alias("marks")).alias("about"), "o_orderdate", "o_totalprice")
    path = scratch_path(spark, "contents")
    write_files(nested.where("o_totalprice > 150000"), path, "json", "append", verify="content")
    write_files(nested.where("o_totalprice <= 150000 or o_totalprice is null"), path, "json", "append", verify="content", sort_by=["o_orderdate"])
    back = read_files(spark, path, "json", schema=nested.schema)
    return back.select("o_orderkey", F.col("about.o_custkey").alias("o_custkey"), F.col("about.marks")[0].alias("mark"), F.size("about.marks").alias("marks"), "o_orderdate", "o_totalprice")


def sketched_month(spark, folder):
    """Events of January by type, merged from sketches of days: counts, and whether estimates are as close as they have to be."""
    path, events = scratch_path(spark, "sketches"), table(spark, folder, "events")
    daily = sketches(events.withColumn("execution_date", F.col("ts").cast("date")), ["execution_date", "event_type"], ["user_id", "props"], ["value"])
    write_files(daily, path, partition_by=["execution_date"])
    merged = merge_sketches(spark, path, "2024-01-01", "2024-01-31", ["event_type"])
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("props").alias("kinds"))
    ranks = events.join(merged.select("event_type", "value_median"), "event_type").groupBy("event_type").agg(
        F.avg((F.col("value") <= F.col("value_median")).cast("int")).alias("below"), F.avg((F.col("value") < F.col("value_median")).cast("int")).alias("under")
    )
    both = merged.join(exact, "event_type").join(ranks, "event_type")
    return both.select(
        "event_type",
        F.col("rows").alias("n"),
        (F.abs(F.col("user_id_distinct") - F.col("users")) <= 0.04 * F.col("users") + 1).alias("users_close"),
        (F.abs(F.col("props_distinct") - F.col("kinds")) <= 0.04 * F.col("kinds") + 1).alias("kinds_close"),
        ((F.col("below") >= 0.48) & (F.col("under") <= 0.52)).alias("median_close"),
    )


CASES = {
    "difference_rows": Case(
        differing_rows,
        """
    with o as (select user_id, event_type, count(*) as n from events group by all),
    w as (select user_id, event_type, 2 * count(*) as n from events where value > 30 group by all),
    b as (select user_id, event_type, coalesce(o.n, 0) as n_old, coalesce(w.n, 0) as n_new from o full join w using (user_id, event_type))
    select user_id, event_type, case when n_old > n_new then 'removed' else 'added' end as change,
        cast(n_old as bigint) as n_old, cast(n_new as bigint) as n_new
    from b where n_old <> n_new""",
    ),
    "difference_keys": Case(
        differing_customers,
        """
    with o as (select c_custkey as key, c_nationkey as nation, c_acctbal as balance, c_mktsegment as segment from customer),
    w as (
        select key, nation, balance, nullif(segment, 'BUILDING') as segment from o where balance >= 0
        union all select -s_suppkey - 1, s_nationkey, s_acctbal, 'S' from supplier
    ),
    d as (
        select *, true as was from (select * from o except all select * from w)
        union all select *, false from (select * from w except all select * from o)
    )
    select d.*exclude (was),
        case when key in (select key from o) and key in (select key from w) then 'changed' when was then 'removed' else 'added' end as change,
        cast(was as bigint) as n_old, cast(not was as bigint) as n_new
    from d""",
    ),
    "upsert_days": Case(
        changed_days,
        """
    with e as (select event_id, user_id, event_type, cast(value as decimal(18,2)) as value, cast(ts as date) as day from events)
    select event_id, user_id, event_type, case when event_type = 'error' then cast(value * 2 as decimal(18,2)) else value end as value,
        case when event_type = 'error' then cast(day + interval 1 day as date) else day end as day
    from e where not (event_type = 'signup' and day > date '2024-01-15')
    union all select -max(event_id) - 1, user_id, 'new', null, date '2024-02-10' from e group by user_id""",
    ),
    "content_checked_write": Case(
        checked_contents,
        "select o_orderkey, o_custkey, o_orderstatus as mark, 2 as marks, o_orderdate, o_totalprice from orders",
    ),
    "sketches_of_a_month": Case(
        sketched_month,
        "select event_type, count(*) as n, true as users_close, true as kinds_close, true as median_close from events group by event_type",
    ),
}
