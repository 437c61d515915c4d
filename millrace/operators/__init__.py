from millrace.operators.asof import asof_join
from millrace.operators.best import top_k
from millrace.operators.columns import add_metadata, apply_transformations, standardize, standardize_columns
from millrace.operators.difference import difference
from millrace.operators.intervals import overlap_join
from millrace.operators.ordered import DenseRank, Lag, Lead, NTile, Rank, Rolling, Running, moving, positions
from millrace.operators.preview import preview
from millrace.operators.sql import sql_transform

__all__ = [
    "DenseRank",
    "Lag",
    "Lead",
    "NTile",
    "Rank",
    "Rolling",
    "Running",
    "add_metadata",
    "apply_transformations",
    "asof_join",
    "difference",
    "moving",
    "overlap_join",
    "positions",
    "preview",
    "sql_transform",
    "standardize",
    "standardize_columns",
    "top_k",
]
