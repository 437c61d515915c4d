from millrace.plans.etl import (
    FileSource,
    JdbcSource,
    PipelineResult,
    PipelineSpec,
    Target,
    run_pipeline,
    spec_from_maps,
)
from millrace.plans.probes import probe_sources, probe_target
from millrace.plans.reports import (
    customer_analytics,
    department_report,
    employee_analytics,
    rep_sales_rollup,
    sales_analytics,
    sample_data_processing,
)
from millrace.plans.routes import REPORTS, run_report
from millrace.plans.sketches import merge_sketches, sketches, write_sketches
from millrace.plans.upsert import UpsertResult, upsert_days

__all__ = [
    "FileSource",
    "JdbcSource",
    "PipelineResult",
    "PipelineSpec",
    "REPORTS",
    "Target",
    "UpsertResult",
    "customer_analytics",
    "department_report",
    "employee_analytics",
    "merge_sketches",
    "probe_sources",
    "probe_target",
    "rep_sales_rollup",
    "run_pipeline",
    "run_report",
    "sales_analytics",
    "sample_data_processing",
    "sketches",
    "spec_from_maps",
    "upsert_days",
    "write_sketches",
]
