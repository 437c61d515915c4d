"""Reports by name, standardised and written under the day they were run for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.columns import standardize
from millrace.plans import reports
from millrace.plans.etl import PipelineResult, Target, deliver
from millrace.plans.probes import probe_sources, probe_target

Tables = Mapping[str, DataFrame]

CHECK = "test-connection"  # fixed value, like the names below

# The names that jobs are started by.
REPORTS: dict[str, Callable[[Tables, date], DataFrame]] = {
    "oracle-to-gcs": lambda t, day: reports.rep_sales_rollup(t["employees"], t["sales"]),
    "employee-analytics": lambda t, day: reports.employee_analytics(t["employees"], t["sales"]),
    "sales-analytics": lambda t, day: reports.sales_analytics(t["sales"]),
    "customer-analytics": lambda t, day: reports.customer_analytics(t["customers"], t["sales"]),
    "department-report": lambda t, day: reports.department_report(t["members"], t["costs"]),
    "sample-data-processing": lambda t, day: reports.sample_data_processing(t["events"], day),
}


def run_report(name: str, tables: Tables, target: Target, run_date: date, source_system: str) -> PipelineResult:
    """Build the report, add audit columns, normalise names, write it as the partition of ``run_date``.

    The date names the output only; ``sample-data-processing`` alone reads the events of that day.
    The sales roll-up is written with the highest revenue first. ``test-connection`` reads a few rows of
    every table, writes markers beside the target and reports both.
    """
    if name == CHECK:
        df = _checked(tables, target)
    elif name in REPORTS:
        df = REPORTS[name](tables, run_date)
    else:
        raise ValueError(f"Unknown report: {name!r}; available: {', '.join([*REPORTS, CHECK])}")
    if name == "oracle-to-gcs" and not target.sort_by:
        target = replace(target, sort_by=(F.desc_nulls_last("total_revenue"),))
    return deliver(standardize(df, source_system), replace(target, run_date=run_date))


def _checked(tables: Tables, target: Target) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    sources = probe_sources(spark, {name: lambda df=df: df for name, df in tables.items()})
    # Readers of the target skip folders whose names begin with an underscore.
    written = probe_target(spark, f"{target.path.rstrip('/')}/_test", target.fmt).withColumn("source", F.lit("target"))
    return sources.unionByName(written).withColumn("rows", F.to_json("rows"))
