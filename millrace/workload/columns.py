"""Column operators, plain joins and group functions on the test tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace.functions.money import cents, total_of, wide
from millrace.operators import (
    DenseRank,
    Lag,
    Lead,
    NTile,
    Rank,
    Rolling,
    Running,
    add_metadata,
    apply_transformations,
    moving,
    positions,
    standardize,
    standardize_columns,
)
from millrace.scratch import materialize
from millrace.workload.case import Case, money, table


def _clock():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def transformed(spark, folder):
    steps = [
        ("doubled", "cast(o_totalprice as decimal(18,2)) * 2"),
        ("doubled", "cast(round(doubled, 2) as decimal(38,2))"),
        ("o_orderstatus", "upper(o_orderstatus)"),
        ("order_year", "year(o_orderdate)"),
    ]
    return apply_transformations(table(spark, folder, "orders"), steps).select(
        "o_orderkey", "doubled", "o_orderstatus", "order_year"
    )


def exploded(spark, folder):
    """A step may change the number of rows: every word of every text."""
    words = apply_transformations(table(spark, folder, "documents"), [("word", "explode(split(text, ' '))")])
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def standardized_names(spark, folder):
    messy = table(spark, folder, "customer").toDF(
        "Cust Key", "cust.name", "Nation-Key", "Acct  Bal ($)", "Mkt - Segment"
    )
    return standardize_columns(messy)


def audited(spark, folder):
    return add_metadata(table(spark, folder, "customer"), "crm", _clock())


def standardized(spark, folder):
    messy = table(spark, folder, "orders").withColumnsRenamed(
        {"o_orderkey": "Order Key", "o_totalprice": "Total-Price", "o_orderdate": "ORDER  DATE"}
    )
    return standardize(messy, "shop", _clock())


def left_join_nulls(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return documents.join(labels, "doc_id", "left").select("doc_id", "quality")


def count_col_vs_star(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("labelled"), "quality")
    return (
        documents.join(labels, documents.doc_id == labels.labelled, "left")
        .groupBy("lang")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("labelled").alias("labelled"),
            F.sum("quality").cast("long").alias("good"),
        )
    )


def row_number_and_lag(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return moving(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"prev": Lag("o_orderkey")}, "rn").select(
        "o_orderkey", "rn", "prev"
    )


def rolling_sum(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", cents("value").alias("value"))
    return moving(events, ["user_id"], ["ts", "event_id"], {"s3": Rolling("sum", "value", 3)}).select(
        "event_id", wide(F.col("s3")).alias("s3")
    )


def blocks_row_number(spark, folder):
    """All lines as few groups, each cut into blocks."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    return positions(lines, ["l_returnflag"], order, "rn", block=1000).drop("l_shipdate")


def blocks_rolling(spark, folder):
    """Events of a type, cut into blocks that a frame reaches across."""
    events = table(spark, folder, "events").select("event_type", "ts", "event_id", cents("value").alias("value"))
    columns = {"s5": Rolling("sum", "value", 5), "n5": Rolling("count", "value", 5), "prev": Lag("event_id", 3)}
    return moving(events, ["event_type"], ["ts", "event_id"], columns, block=100).select(
        "event_id", wide(F.col("s5")).alias("s5"), "n5", "prev"
    )


def blocks_running(spark, folder):
    """Frames from the first row on, carried across blocks."""
    events = table(spark, folder, "events").select("event_type", "ts", "event_id", "user_id", cents("value").alias("value"))
    clicked = events.withColumn("clicker", F.when(F.col("event_id") % 7 == 0, F.col("user_id")))
    columns = {
        "total": Running("sum", "value"),
        "least": Running("min", "value"),
        "most": Running("max", "value"),
        "clickers": Running("count", "clicker"),
        "last_clicker": Running("last", "clicker"),
        "next": Lead("event_id", 2),
        "tenth": NTile(10),
    }
    found = moving(clicked, ["event_type"], ["ts", "event_id"], columns, block=100)
    return found.select("event_id", *[wide(F.col(c)).alias(c) for c in ("total", "least", "most")], "clickers", "last_clicker", "next", "tenth")


def blocks_rank(spark, folder):
    """Lines of a flag ranked by quantity: many tie, and those that do lie in several blocks."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return moving(lines, ["l_returnflag"], [F.desc("l_quantity")], {"place": Rank(), "step": DenseRank()}, block=1000).drop("l_returnflag")


def live_clock(spark, folder):
    """The default clock: one moment for all rows, not before the call and not after the read, and its day."""
    before = F.lit(datetime.now(timezone.utc))
    rows = materialize(add_metadata(table(spark, folder, "customer"), "crm"), "clock")
    moment = F.col("_ingestion_timestamp")
    return rows.groupBy("_source_system").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(moment).alias("moments"),
        F.bool_and(moment.between(before, F.current_timestamp())).alias("between_start_and_now"),
        F.bool_and(F.col("_processing_date") == moment.cast("date")).alias("its_day"),
    )


def group_totals(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        total_of("l_extendedprice").alias("gross"),
        F.min("l_discount").alias("least_discount"),
        F.max("l_discount").alias("most_discount"),
        F.count_distinct("l_partkey").alias("parts"),
    )


_AUDIT = """timestamp '2024-01-01 00:00:00' as _ingestion_timestamp, date '2024-01-01' as _processing_date"""

CASES = {
    "apply_transformations": Case(
        transformed,
        """
    select o_orderkey, cast(round(cast(o_totalprice as decimal(18,2)) * 2, 2) as decimal(38,2)) as doubled,
           upper(o_orderstatus) as o_orderstatus, cast(year(o_orderdate) as int) as order_year
    from orders""",
    ),
    "apply_transformations_explode": Case(
        exploded,
        """
    select lang, word, count(*) as n
    from (select lang, unnest(string_split(text, ' ')) as word from documents) group by lang, word""",
    ),
    "standardize_columns": Case(
        standardized_names,
        """
    select c_custkey as cust_key, c_name as custname, c_nationkey as nation_key, c_acctbal as acct_bal_,
           c_mktsegment as mkt_segment
    from customer""",
    ),
    "add_metadata": Case(audited, f"select *, {_AUDIT}, 'crm' as _source_system from customer"),
    "live_clock": Case(
        live_clock,
        "select 'crm' as _source_system, count(*) as n, cast(1 as bigint) as moments, true as between_start_and_now, true as its_day from customer",
    ),
    "standardize": Case(
        standardized,
        f"""
    select o_orderkey as order_key, o_custkey, o_orderstatus, o_totalprice as total_price, o_orderdate as order_date,
           o_orderpriority, {_AUDIT}, 'shop' as _source_system
    from orders""",
    ),
    "left_join_nulls": Case(
        left_join_nulls,
        "select d.doc_id, l.quality from documents d left join labels l on d.doc_id = l.doc_id",
    ),
    "count_col_vs_star": Case(
        count_col_vs_star,
        """
    select d.lang, count(*) as n, count(l.doc_id) as labelled, cast(sum(l.quality) as bigint) as good
    from documents d left join labels l on d.doc_id = l.doc_id group by d.lang""",
    ),
    "group_totals": Case(
        group_totals,
        f"""
    select l_returnflag, l_linestatus, count(*) as n, {money("l_extendedprice")} as gross,
           min(l_discount) as least_discount, max(l_discount) as most_discount, count(distinct l_partkey) as parts
    from lineitem group by l_returnflag, l_linestatus""",
    ),
    "window_row_number_lag": Case(
        row_number_and_lag,
        """
    select o_orderkey, row_number() over w as rn, lag(o_orderkey) over w as prev
    from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
    ),
    "window_blocks_row_number": Case(
        blocks_row_number,
        """
    select l_returnflag, l_orderkey, l_linenumber, l_partkey, row_number() over (
             partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey) as rn
    from lineitem""",
    ),
    "window_blocks_rolling": Case(
        blocks_rolling,
        """
    select event_id, cast(sum(cast(value as decimal(18,2))) over w as decimal(38,2)) as s5, count(value) over w as n5,
           lag(event_id, 3) over (partition by event_type order by ts, event_id) as prev
    from events window w as (partition by event_type order by ts, event_id rows between 4 preceding and current row)""",
    ),
    "window_blocks_running": Case(
        blocks_running,
        """
    select event_id, cast(sum(v) over w as decimal(38,2)) as total, cast(min(v) over w as decimal(38,2)) as least,
           cast(max(v) over w as decimal(38,2)) as most, count(clicker) over w as clickers,
           last_value(clicker ignore nulls) over w as last_clicker, lead(event_id, 2) over o as next, ntile(10) over o as tenth
    from (select *, cast(value as decimal(18,2)) as v, case when event_id % 7 = 0 then user_id end as clicker from events)
    window o as (partition by event_type order by ts, event_id),
           w as (partition by event_type order by ts, event_id rows between unbounded preceding and current row)""",
    ),
    "window_blocks_rank": Case(
        blocks_rank,
        """
    select l_orderkey, l_linenumber, l_partkey, l_quantity, rank() over w as place, dense_rank() over w as step
    from lineitem window w as (partition by l_returnflag order by l_quantity desc)""",
    ),
    "window_rolling_sum": Case(
        rolling_sum,
        """
    select event_id, cast(sum(cast(value as decimal(18,2))) over (
             partition by user_id order by ts, event_id rows between 2 preceding and current row) as decimal(38,2)) as s3
    from events""",
    ),
}
