"""File writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from threading import Thread

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.formats import CSV_NULL, TIMESTAMP_FORMATS, checked_format
from millrace.operators.contents import checksum
from millrace.operators.spread import with_hashes, with_numbers
from millrace.paths import overlap, path_exists, qualified, read_paths
from millrace.sources.files import read_files

# The save modes Spark knows.
SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists", "default")

_PATIENCE = 600  # seconds


class WriteVerificationError(RuntimeError):
    """The rows found after a write are not the rows that were written."""


@dataclass(frozen=True)
class WriteResult:
    """``rows`` is None if Spark did not report the count of a write that succeeded."""

    path: str
    fmt: str
    mode: str
    rows: int | None
    skipped: bool = False


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str | Column] = (),
    rebalance: bool = False,
    verify: bool | str = False,
    options: Mapping[str, object] | None = None,
    split_copies: bool = False,
) -> WriteResult:
    """Write ``df`` below ``path`` in a single job that also counts its rows.

    With ``partition_by``, ``mode="overwrite"`` replaces only the partitions that ``df`` has rows
    for, unless the option ``partitionOverwriteMode`` is ``static``: then all of ``path`` goes. An empty text
    is refused as a partition value, because folders cannot tell it from null; readers that want other types than
    folder names suggest (``007``) pass a schema.

    ``sort_by`` orders the rows across all output files and lets rows of equal keys lie in several of them;
    ``split_copies`` lets even copies of one row, at the price of a sort within each task before. ``rebalance`` shuffles rows of equal
    partition values together and evens out the file sizes; Spark splits values that are too big
    for one task. ``verify`` reads the target back and compares counts; ``verify="content"`` compares checksums of whole
    rows too, which are summed in the stage that writes, and over what is read back: a changed cell, a row too many or cells
    that changed places raise. ``mode="ignore"`` leaves an existing target alone.

    Overwriting a path that ``df`` still reads from is refused, as it would lose the data. Replacing
    partitions of it is fine: Spark puts them in place after everything has been read.
    """
    fmt, mode = checked_format(fmt), checked_mode(mode)
    if verify not in (True, False, "content"):
        raise ValueError(f"verify is True, False or 'content', not {verify!r}")
    spark = df.sparkSession
    partition_by = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    sort_by = [sort_by] if isinstance(sort_by, (str, Column)) else list(sort_by)
    if verify and mode == "overwrite" and _dynamic(partition_by, options):
        raise ValueError("verify cannot tell replaced partitions from kept ones; verify an unpartitioned write")
    if mode == "overwrite" and not _dynamic(partition_by, options):
        refuse_overlap(df, path)
    if mode == "ignore" and path_exists(spark, path):
        return WriteResult(path, fmt, mode, 0, skipped=True)

    # Counts of rows or, for their contents, counts and checksums: sums, so that those of an append add up.
    sums = checksum(df) if verify == "content" else [F.count(F.lit(1)).alias("rows")]

    def summed(rows: DataFrame) -> list:
        return list(rows.agg(*sums).first())

    def stored() -> list:
        # In the order of the data, as readers put partition columns last.
        return summed(read_files(spark, path, fmt, schema=df.schema, options=options).select(*[_named(c) for c in df.columns]))

    before = stored() if verify and mode == "append" and path_exists(spark, path) else [0] * len(sums)
    observed = Observation()
    # The count sits in the stage that writes: a stage before a shuffle may run a task twice,
    # or once more to sample sort ranges, and would count it again.
    placed = _placed(_checked(df, partition_by), partition_by, sort_by, rebalance, split_copies).observe(observed, *sums)
    writer = placed.write.mode(mode).format(fmt).options(**_options(df, fmt, partition_by))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.options(**(options or {})).save(path)
    written = _reported(observed)
    if verify:
        found = [now - then for now, then in zip(stored(), before)]
        if written is None:  # not a mismatch: what was observed was lost, so the data is summed once more
            written = dict(zip(("rows", "sum_1", "sum_2"), summed(df)))
        if found[0] != written["rows"]:
            raise WriteVerificationError(f"Wrote {written['rows']} rows to {path} but found {found[0]}")
        if found != list(written.values()):
            raise WriteVerificationError(f"Wrote {written['rows']} rows to {path} but found others")
    return WriteResult(path, fmt, mode, written and written["rows"])


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _reported(observed: Observation) -> dict | None:
    """The count, which comes through the listener bus; an overloaded driver may drop it there."""
    found: list[dict] = []
    waiting = Thread(target=lambda: found.append(observed.get), daemon=True)
    waiting.start()
    waiting.join(_PATIENCE)
    return found[0] if found else None


def checked_mode(mode: str) -> str:
    if mode.lower() not in SAVE_MODES:
        raise ValueError(f"Unsupported save mode: {mode!r}; expected one of {', '.join(SAVE_MODES)}")
    return mode.lower()


def refuse_overlap(df: DataFrame, path: str) -> None:
    target = qualified(df.sparkSession, path)
    for source in read_paths(df):
        if overlap(source, target):
            raise ValueError(f"Cannot overwrite {target}: the data to write is read from {source}")


def _dynamic(partition_by: list[str], options: Mapping[str, object] | None) -> bool:
    chosen = {key.lower(): str(value).lower() for key, value in (options or {}).items()}
    return bool(partition_by) and chosen.get("partitionoverwritemode", "dynamic") == "dynamic"


def _checked(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """An empty text among the partition values stops the write."""
    wanted = {name.lower() for name in partition_by}
    for column in df.schema:
        if column.name.lower() in wanted and column.dataType.simpleString() == "string":
            value = F.col(f"`{column.name}`")
            told = F.raise_error(F.lit(f"Partition column {column.name} holds an empty text"))
            df = df.withColumn(column.name, F.when(value == "", told).otherwise(value))
    return df


def _placed(
    df: DataFrame, partition_by: list[str], sort_by: list[str | Column], rebalance: bool, split_copies: bool
) -> DataFrame:
    if sort_by:
        tied, tie = with_numbers(df) if split_copies else with_hashes(df)
        return tied.orderBy(*partition_by, *sort_by, tie).drop(tie)
    if rebalance:
        return df.hint("rebalance", *partition_by)
    return df


def _options(df: DataFrame, fmt: str, partition_by: list[str]) -> dict[str, object]:
    if fmt == "csv":
        chosen = {
            "header": True,
            "escape": '"',
            "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False,
            **TIMESTAMP_FORMATS,
        }
        if len(df.columns) == len(partition_by) + 1:  # a lone null would be an empty line, which readers skip
            chosen["nullValue"] = CSV_NULL
        return chosen
    if fmt == "json":
        return {"ignoreNullFields": False, **TIMESTAMP_FORMATS}
    return {}
