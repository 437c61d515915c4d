"""Configured batch data jobs on Spark DataFrames."""

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
    asof_join,
    difference,
    moving,
    overlap_join,
    positions,
    preview,
    sql_transform,
    standardize,
    standardize_columns,
    top_k,
)
from millrace.plans import (
    FileSource,
    JdbcSource,
    PipelineResult,
    PipelineSpec,
    Target,
    UpsertResult,
    merge_sketches,
    probe_sources,
    probe_target,
    run_pipeline,
    run_report,
    spec_from_maps,
    upsert_days,
    write_sketches,
)
from millrace.sinks import WriteResult, WriteVerificationError, write_files
from millrace.sources import read_files, read_jdbc

__all__ = [
    "DenseRank",
    "FileSource",
    "JdbcSource",
    "Lag",
    "Lead",
    "NTile",
    "PipelineResult",
    "PipelineSpec",
    "Rank",
    "Rolling",
    "Running",
    "Target",
    "UpsertResult",
    "WriteResult",
    "WriteVerificationError",
    "add_metadata",
    "apply_transformations",
    "asof_join",
    "difference",
    "merge_sketches",
    "moving",
    "overlap_join",
    "positions",
    "preview",
    "probe_sources",
    "probe_target",
    "read_files",
    "read_jdbc",
    "run_pipeline",
    "run_report",
    "spec_from_maps",
    "sql_transform",
    "standardize",
    "standardize_columns",
    "top_k",
    "upsert_days",
    "write_files",
    "write_sketches",
]
