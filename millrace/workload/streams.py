"""Jobs on streams of the given tables' files, run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.etl import FileSource, PipelineSpec, Target
from millrace.scratch import scratch_path
from millrace.sinks import write_files
from millrace.sources import read_files
from millrace.streaming import batch_sessions, run_stream, stream_sessions
from millrace.workload.case import Case, table

_GAP, _DELAY = "10 minutes", "1 hour"


def streamed_job(spark, folder):
    """Orders as a stream of dated CSV files, shaped and added to a target in several batches; then once more, with nothing new."""
    orders, arrived, path = table(spark, folder, "orders"), scratch_path(spark, "arrived"), scratch_path(spark, "target")
    own = orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("Total Price"), F.year("o_orderdate").alias("year"))
    write_files(own, arrived, "csv", partition_by=["year"], rebalance=True)
    spec = PipelineSpec(
        FileSource(arrived, "csv", schema="o_orderkey long, o_custkey long, `Total Price` decimal(18,2), year int"),
        Target(path, "parquet", "append", run_date="2024-06-09"),
        "shop",
        "select o_orderkey, o_custkey, `Total Price` from source_data where `Total Price` > 1000",
        steps=(("Band", "case when `Total Price` > 200000 then 'high' else 'low' end"),),
    )
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        run_stream(spark, spec, checkpoint, files_per_batch=3)
    return read_files(spark, path, "parquet").select("o_orderkey", "o_custkey", "total_price", "band")


def streamed_sessions(spark, folder):
    """Sessions of all events by user: those that the stream has closed, and those that are still open at its end."""
    arrived, out, checkpoint = (scratch_path(spark, x) for x in ("arrived", "tables", "checkpoint"))
    events = table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"))
    write_files(events, arrived)
    stream = spark.readStream.schema(events.schema).parquet(arrived)
    stream_sessions(stream, out, checkpoint, ["user_id"], "ts", _GAP, _DELAY, ["value"])
    closed = spark.read.parquet(f"{out}/sessions")
    kept = read_files(spark, f"{out}/events", "parquet").where("late = 'false'")
    bound = kept.agg((F.max("ts") - F.expr(f"interval {_DELAY}")).alias("bound"))
    still_open = batch_sessions(kept, ["user_id"], "ts", _GAP, ["value"]).join(bound, F.col("session_end") > F.col("bound")).drop("bound")
    both = closed.withColumn("closed", F.lit(True)).unionByName(still_open.withColumn("closed", F.lit(False)))
    spans = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    return both.withColumns(spans).withColumns({"n": F.col("rows"), "value": F.col("value").cast("decimal(38,2)")}).drop("rows")


CASES = {
    "stream_job": Case(
        streamed_job,
        """
    select o_orderkey, o_custkey, cast(o_totalprice as decimal(18,2)) as total_price,
        case when cast(o_totalprice as decimal(18,2)) > 200000 then 'high' else 'low' end as band
    from orders where cast(o_totalprice as decimal(18,2)) > 1000""",
    ),
    "stream_sessions": Case(
        streamed_sessions,
        """
    with e as (select user_id, ts, cast(value as decimal(18,2)) as v, lag(ts) over (partition by user_id order by ts, event_id) as p, event_id from events),
    s as (select *, sum(case when p is null or ts > p + interval 10 minute then 1 else 0 end) over (partition by user_id order by ts, event_id) as k from e)
    select user_id, min(ts) as session_start, max(ts) + interval 10 minute as session_end, count(*) as n, cast(sum(v) as decimal(38,2)) as value,
        max(ts) + interval 10 minute <= (select max(ts) - interval 1 hour from events) as closed
    from s group by user_id, k""",
    ),
}
