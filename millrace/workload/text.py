"""What SQL text can say, run through ``sql_transform``.

Views carry the prefix ``src_``. Where the two engines spell a thing differently, the oracle text
is given apart. Keys are made distinct before a semi join or a set operation, so that a hot key is
folded by the map tasks instead of being shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators import sql_transform
from millrace.workload.case import Case, money, table


def _case(tables: str, text: str, oracle: str | None = None) -> Case:
    main, *others = tables.split()

    def run(spark: SparkSession, folder: str) -> DataFrame:
        frames = {f"src_{name}": table(spark, folder, name) for name in others}
        return sql_transform(table(spark, folder, main), text, f"src_{main}", frames)

    return Case(run, (oracle or text).replace("src_", ""))


CASES = {
    "sql_transform": _case(
        "orders",
        "select o_orderpriority, count(*) as n from src_orders where o_totalprice > 100000 group by o_orderpriority;",
    ),
    "sql_semi_join": _case(
        "customer orders",
        """
    select c_custkey from src_customer
    where exists (select 1 from (select distinct o_custkey from src_orders where o_totalprice > 480000) o
                  where o.o_custkey = c_custkey)""",
    ),
    "sql_anti_join": _case(
        "orders lineitem",
        """
    select o_orderkey from src_orders
    where not exists (select 1 from (select distinct l_orderkey from src_lineitem) l where l.l_orderkey = o_orderkey)""",
    ),
    "sql_right_join": _case(
        "documents labels",
        """
    select d.doc_id, l.toxic from src_labels l right join src_documents d on l.doc_id = d.doc_id""",
    ),
    "sql_full_join": _case(
        "documents labels",
        """
    select d.doc_id as document, l.doc_id as label
    from src_documents d full join src_labels l on d.doc_id = l.doc_id""",
    ),
    "sql_inequality_join": _case(
        "lineitem orders",
        """
    select l_orderkey, l_linenumber, l_partkey, o_custkey
    from src_lineitem join src_orders on l_orderkey = o_orderkey and l_shipdate > o_orderdate + interval '60' day""",
    ),
    "sql_rollup": _case(
        "lineitem",
        """
    select l_returnflag, l_linestatus, count(*) as n from src_lineitem group by rollup(l_returnflag, l_linestatus)""",
    ),
    "sql_cube": _case(
        "lineitem",
        "select l_returnflag, l_linestatus, count(*) as n from src_lineitem group by cube(l_returnflag, l_linestatus)",
    ),
    "sql_grouping_sets": _case(
        "lineitem",
        """
    select l_returnflag, l_linestatus, count(*) as n
    from src_lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())""",
    ),
    "sql_having": _case(
        "orders", "select o_custkey, count(*) as n from src_orders group by o_custkey having count(*) > 15"
    ),
    "sql_distinct": _case("orders", "select distinct o_custkey, o_orderpriority from src_orders"),
    "sql_approx_distinct": _case(
        "events",
        """
    select event_type, abs(approx_count_distinct(event_id, 0.01) - count(*)) <= 0.05 * count(*) as close
    from src_events group by event_type""",
        "select distinct event_type, true as close from src_events",
    ),
    "sql_window_by_month": _case(
        "orders",
        f"""
    with months as (
      select cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m,
             {money("o_totalprice")} as revenue
      from src_orders group by 1, 2)
    select y, m, revenue,
           cast(rank() over (partition by y order by revenue desc) as int) as place,
           lag(revenue) over (partition by y order by m) as previous,
           cast(sum(revenue) over (partition by y order by m rows between 2 preceding and current row)
                as decimal(38,2)) as quarter
    from months""",
    ),
    "sql_top_k": _case(
        "orders", "select o_orderkey, o_totalprice from src_orders order by o_totalprice desc, o_orderkey limit 10"
    ),
    "sql_union": _case(
        "orders customer",
        """
    select o_custkey as k from src_orders union select c_custkey from src_customer""",
    ),
    "sql_union_all": _case(
        "orders lineitem",
        """
    select o_orderkey as k, o_totalprice as amount from src_orders
    union all select l_orderkey, l_extendedprice from src_lineitem""",
    ),
    "sql_intersect": _case(
        "orders",
        """
    select distinct o_custkey as k from src_orders where o_orderstatus = 'F'
    intersect select distinct o_custkey from src_orders where o_orderpriority = '1-URGENT'""",
    ),
    "sql_except": _case(
        "orders lineitem", "select o_orderkey as k from src_orders except select l_orderkey from src_lineitem"
    ),
    "sql_strings": _case(
        "customer",
        """
    select c_custkey, upper(c_mktsegment) as u, lower(c_mktsegment) as l, substr(c_name, 10, 5) as sub,
           cast(length(c_name) as int) as len, replace(c_name, '#', '-') as r, trim(concat('  ', c_name, ' ')) as t,
           concat(c_name, '|', c_mktsegment) as cc, lpad(cast(c_nationkey as string), 4, '0') as p
    from src_customer""",
    ),
    "sql_text_length": _case(
        "documents",
        """
    select doc_id, cast(length(text) as int) as n, cast(length(replace(text, ' ', '')) as int) as dense, md5(text) as h
    from src_documents""",
    ),
    "sql_math": _case(
        "customer",
        """
    select c_custkey, abs(c_acctbal) as a, cast(floor(c_acctbal) as bigint) as f, cast(ceil(c_acctbal) as bigint) as c,
           c_acctbal / 2 as h, cast(c_custkey % 7 as int) as r, cast(sign(c_acctbal) as int) as s,
           cast(cast(c_acctbal as decimal(18,2)) * 1.5 as decimal(38,3)) as d
    from src_customer""",
    ),
    "sql_dates": _case(
        "orders",
        """
    select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as m, date_add(cast(o_orderdate as date), 7) as d7,
           cast(day(o_orderdate) as int) as d, datediff(date '2002-01-01', cast(o_orderdate as date)) as age
    from src_orders""",
        """
    select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as m,
           cast(o_orderdate + interval 7 day as date) as d7, cast(day(o_orderdate) as int) as d,
           cast(date_diff('day', cast(o_orderdate as date), date '2002-01-01') as int) as age
    from src_orders""",
    ),
    "sql_scalar_subquery": _case(
        "orders",
        """
    select o_orderkey from src_orders
    where o_totalprice > (select avg(cast(o_totalprice as decimal(18,2))) from src_orders)""",
    ),
    "sql_conditionals": _case(
        "orders",
        """
    select o_orderkey, case when o_totalprice > 250000 then 'hi' else 'lo' end as b,
           coalesce(nullif(o_orderstatus, 'P'), 'x') as c, o_orderpriority in ('1-URGENT', '2-HIGH') as hot,
           o_orderpriority like '%LOW' as low, o_totalprice between 1000 and 50000 as small
    from src_orders""",
    ),
    "sql_json": _case(
        "events",
        "select event_id, cast(get_json_object(props, '$.k') as bigint) as k from src_events",
        "select event_id, cast(json_extract(props, '$.k') as bigint) as k from src_events",
    ),
    "sql_arrays": _case(
        "embeddings",
        "select vec_id, size(embedding) as n, embedding[0] as head, array_max(embedding) as top from src_embeddings",
        """
    select vec_id, cast(len(embedding) as int) as n, embedding[1] as head, list_max(embedding) as top
    from src_embeddings""",
    ),
    "sql_maps": _case(
        "events",
        """
    select event_type, coalesce(map_from_entries(sort_array(collect_list(struct(weekday, n))))[2], 0) as mondays
    from (select event_type, cast(dayofweek(ts) as int) as weekday, count(*) as n from src_events group by 1, 2)
    group by event_type""",
        "select event_type, count(*) filter (where dayofweek(ts) = 1) as mondays from src_events group by event_type",
    ),
}
