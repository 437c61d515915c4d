"""Joins by time and first rows per group, hot groups cut."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from millrace.operators import asof_join, overlap_join, top_k
from millrace.workload.case import Case, table


def latest_order(spark, folder):
    """Each event with the last order that its user has placed until then."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    found = asof_join(events, orders, ("ts", "o_orderdate"), [("user_id", "o_custkey")], ties=["o_orderkey"])
    return found.select("event_id", "o_orderkey", "o_orderdate", "o_totalprice")


def events_before(spark, folder):
    """Each event with the last large one of its type, in the two hours before; types are few, so all of them are cut."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    large = table(spark, folder, "events").where("value > 50").select(
        F.col("event_id").alias("large_id"), F.col("event_type").alias("large_type"), F.col("ts").alias("large_ts")
    )
    on, by = ("ts", "large_ts"), [("event_type", "large_type")]
    found = asof_join(events, large, on, by, exact=False, tolerance=timedelta(hours=2), ties=["large_id"], block=150)
    return found.select("event_id", "large_id", "large_ts")


def next_view(spark, folder):
    """Purchases with the next view of the same user, of those that have one."""
    events = table(spark, folder, "events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), F.col("ts").alias("seen"))
    found = asof_join(purchases, views, ("ts", "seen"), [("user_id", "viewer")], "forward", how="inner", ties=["view_id"])
    return found.select("event_id", "view_id", "seen")


def _spans(spark, folder, kind, length, prefix):
    events = table(spark, folder, "events").where(F.col("event_type") == kind)
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), length.cast("decimal(18,6)"))
    return events.select(
        F.col("event_id").alias(f"{prefix}_id"), F.col("user_id").alias(f"{prefix}_user"), F.col("ts").alias(f"{prefix}_from"), end.alias(f"{prefix}_to")
    )


def overlapping(spark, folder):
    """Spans of very unlike lengths of the same user that overlap."""
    errors = _spans(spark, folder, "error", F.col("event_id") % 9001, "error")
    clicks = _spans(spark, folder, "click", F.pow(F.lit(2.0), F.col("event_id") % 18), "click")
    found = overlap_join(errors, clicks, ("error_from", "error_to"), ("click_from", "click_to"), [("error_user", "click_user")])
    return found.select("error_id", "click_id")


def overlapping_days(spark, folder):
    """Open and finished orders of a customer whose days of delivery overlap: closed spans of days."""
    orders = table(spark, folder, "orders")

    def spans(prefix, status):
        first = F.col("o_orderdate").cast("date")
        return orders.where(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").alias(f"{prefix}_key"), F.col("o_custkey").alias(f"{prefix}_customer"), first.alias(f"{prefix}_from"), F.date_add(first, (F.col("o_orderkey") % 30).cast("int")).alias(f"{prefix}_to")
        )

    by = [("open_customer", "done_customer")]
    found = overlap_join(spans("open", "O"), spans("done", "F"), ("open_from", "open_to"), ("done_from", "done_to"), by, closed=True)
    return found.select("open_key", "done_key")


def best_lines(spark, folder):
    """The dearest lines of a flag, of which there are three."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return top_k(lines, ["l_returnflag"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"], 25, "place")


def best_lines_with_ties(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return top_k(lines, ["l_suppkey"], [F.desc("l_quantity")], 3, "place", ties=True)


CASES = {
    "asof_join": Case(
        latest_order,
        """
    with o as (
        select o_custkey, o_orderdate, o_orderkey, o_totalprice from orders
        qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1
    )
    select e.event_id, o.o_orderkey, o.o_orderdate, o.o_totalprice
    from events e asof left join o on e.user_id = o.o_custkey and e.ts >= o.o_orderdate""",
    ),
    "asof_join_blocks": Case(
        events_before,
        """
    with l as (
        select event_id as large_id, event_type, ts as large_ts from events where value > 50
        qualify row_number() over (partition by event_type, ts order by event_id desc) = 1
    )
    select e.event_id, case when l.large_ts >= e.ts - interval 2 hour then l.large_id end as large_id,
        case when l.large_ts >= e.ts - interval 2 hour then l.large_ts end as large_ts
    from events e asof left join l on e.event_type = l.event_type and e.ts > l.large_ts""",
    ),
    "asof_join_forward": Case(
        next_view,
        """
    with v as (
        select event_id as view_id, user_id, ts as seen from events where event_type = 'view'
        qualify row_number() over (partition by user_id, ts order by event_id desc) = 1
    )
    select e.event_id, v.view_id, v.seen
    from (select * from events where event_type = 'purchase') e asof join v on e.user_id = v.user_id and e.ts <= v.seen""",
    ),
    "interval_join": Case(
        overlapping,
        """
    with x as (select event_id, user_id, ts as a, ts + to_seconds(event_id % 9001) as b from events where event_type = 'error'),
    y as (select event_id, user_id, ts as a, ts + to_seconds(cast(pow(2, event_id % 18) as bigint)) as b from events where event_type = 'click')
    select x.event_id as error_id, y.event_id as click_id
    from x join y on x.user_id = y.user_id and x.a < y.b and y.a < x.b and x.a < x.b and y.a < y.b""",
    ),
    "interval_join_days": Case(
        overlapping_days,
        """
    with s as (
        select o_orderkey as k, o_custkey as c, o_orderstatus as status, cast(o_orderdate as date) as a,
            cast(o_orderdate as date) + cast(o_orderkey % 30 as int) as b
        from orders
    )
    select x.k as open_key, y.k as done_key from s x join s y on x.c = y.c and x.status = 'O' and y.status = 'F' and x.a <= y.b and y.a <= x.b""",
    ),
    "top_k_hot_groups": Case(
        best_lines,
        """
    select l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice, row_number() over w as place from lineitem
    window w as (partition by l_returnflag order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey)
    qualify place <= 25""",
    ),
    "top_k_with_ties": Case(
        best_lines_with_ties,
        """
    select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, rank() over (partition by l_suppkey order by l_quantity desc) as place
    from lineitem qualify place <= 3""",
    ),
}
