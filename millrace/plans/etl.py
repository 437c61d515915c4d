"""The configured job: extract, SQL, column steps, audit columns, names, write."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.formats import checked_format
from millrace.operators.columns import apply_transformations, standardize
from millrace.operators.sql import sql_transform
from millrace.sinks.files import checked_mode, refuse_overlap, write_files
from millrace.sources.files import read_files
from millrace.sources.jdbc import read_jdbc

RUN_DATE = "execution_date"
_STEP_PREFIX = "transform_"  # fixed value, like the other configuration keys in spec_from_maps


@dataclass(frozen=True)
class FileSource:
    path: str | list[str]
    fmt: str = "csv"
    header: bool = True
    schema: StructType | str | None = None
    multi_line: bool | None = None
    options: Mapping[str, object] = field(default_factory=dict)

    def load(self, spark: SparkSession) -> DataFrame:
        return read_files(spark, self.path, self.fmt, self.header, self.schema, self.multi_line, self.options)


@dataclass(frozen=True)
class JdbcSource:
    url: str = field(repr=False)
    query: str
    options: Mapping[str, object] = field(default_factory=dict, repr=False)
    partition_column: str | None = None
    lower: object = None
    upper: object = None
    num_partitions: int | None = None
    predicates: tuple[str, ...] | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        return read_jdbc(
            spark,
            self.url,
            self.query,
            self.options,
            self.partition_column,
            self.lower,
            self.upper,
            self.num_partitions,
            self.predicates,
        )


@dataclass(frozen=True)
class Target:
    """Where to write.

    ``run_date`` puts the data into a folder of that day, ``execution_date=<day>`` below ``path``, which readers
    of ``path`` see as a partition column. Overwriting replaces the whole day, whatever rows the rerun
    has, and no other day; appending, ``ignore`` and ``error`` look at that day alone. All days
    of a target must have the same ``partition_by``, or ``path`` cannot be read as one table.
    """

    path: str
    fmt: str = "parquet"
    mode: str = "overwrite"
    run_date: date | str | None = None
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str | Column, ...] = ()
    rebalance: bool = False
    verify: bool = False
    options: Mapping[str, object] = field(default_factory=dict)
    split_copies: bool = False

    @property
    def replaces_a_folder(self) -> bool:
        return self.mode.lower() == "overwrite" and (self.run_date is not None or not self.partition_by)

    @property
    def folder(self) -> str:
        """What is written, and replaced, as a whole."""
        if self.run_date is None:
            return self.path
        return f"{self.path.rstrip('/')}/{RUN_DATE}={_day(self.run_date)}"


@dataclass(frozen=True)
class PipelineSpec:
    source: FileSource | JdbcSource
    target: Target
    source_system: str
    sql: str | None = None
    view: str = "source_data"
    steps: tuple[tuple[str, str], ...] = ()
    clock: Column | datetime | None = None
    replace_metadata: bool = False
    on_collision: str = "error"


@dataclass(frozen=True)
class PipelineResult:
    path: str
    rows_out: int | None
    rows_in: int | None = None
    skipped: bool = False


def run_pipeline(spark: SparkSession, spec: PipelineSpec, count_input: bool = False) -> PipelineResult:
    """Run ``spec`` with one write job, which also counts the output.

    ``count_input`` counts the source in a job of its own: cheap for Parquet, whose footers hold
    the counts, but a second read of anything else. Counting inside the write job would keep
    filters from reaching the scan.
    """
    _check_target(spec.target)
    source = spec.source.load(spark)
    result = shape(source, spec)
    if spec.target.replaces_a_folder:
        refuse_overlap(result, spec.target.folder)
    rows_in = source.count() if count_input else None
    return deliver(result, spec.target, rows_in)


def shape(source: DataFrame, spec: PipelineSpec) -> DataFrame:
    """The lazy middle of the job: everything between reading and writing."""
    df = source
    if spec.sql is not None:
        df = sql_transform(df, spec.sql, spec.view)
    df = apply_transformations(df, spec.steps)
    return standardize(df, spec.source_system, spec.clock, spec.replace_metadata, spec.on_collision)


def deliver(df: DataFrame, target: Target, rows_in: int | None = None) -> PipelineResult:
    _check_target(target)
    options = dict(target.options)
    if target.run_date is not None:
        if RUN_DATE in [name.lower() for name in df.columns]:
            raise ValueError(f"The data already has a column {RUN_DATE}")
        options.setdefault("partitionOverwriteMode", "static")
    written = write_files(
        df,
        target.folder,
        target.fmt,
        target.mode,
        target.partition_by,
        target.sort_by,
        target.rebalance,
        target.verify,
        options,
        target.split_copies,
    )
    return PipelineResult(target.path, written.rows, rows_in, written.skipped)


def spec_from_maps(
    source_type: str,
    source: Mapping[str, str],
    transform: Mapping[str, str],
    target: Mapping[str, str],
    credentials: Callable[[str, str], Mapping[str, str]] | None = None,
    source_system: str | None = None,
) -> PipelineSpec:
    """A spec from plain string maps, as a job's configuration file would hold them.

    ``source_type`` is ``oracle`` (``project_id``, ``secret_id``, ``query``) or ``gcs``
    (``file_path``, ``file_format``, ``header``, and ``multi_line`` and ``schema`` as :func:`read_files`
    takes them), in any case. ``transform`` may hold ``sql_query``,
    ``temp_view`` and one ``transform_<column>`` per step; ``target`` holds ``output_path``,
    ``file_format`` and ``mode``. ``credentials`` looks up ``url`` and connection options by
    project and secret.
    """
    kind = source_type.lower()
    if kind == "oracle":
        if credentials is None:
            raise ValueError("A database source needs a credentials lookup")
        found = dict(credentials(source["project_id"], source["secret_id"]))
        chosen: FileSource | JdbcSource = JdbcSource(found.pop("url"), source["query"], found)
    elif kind == "gcs":
        chosen = FileSource(
            source["file_path"],
            source.get("file_format", "csv"),
            _flag(source.get("header", "true")),
            source.get("schema"),
            _flag(source["multi_line"]) if "multi_line" in source else None,
        )
    else:
        raise ValueError(f"Unsupported source type: {source_type!r}")
    return PipelineSpec(
        source=chosen,
        target=Target(target["output_path"], target.get("file_format", "parquet"), target.get("mode", "overwrite")),
        source_system=source_system or kind,
        sql=transform.get("sql_query"),
        view=transform.get("temp_view", "source_data"),
        steps=tuple(
            (key.removeprefix(_STEP_PREFIX), text) for key, text in transform.items() if key.startswith(_STEP_PREFIX)
        ),
    )


def _check_target(target: Target) -> None:
    checked_format(target.fmt)
    checked_mode(target.mode)


def _day(run_date: date | str) -> str:
    return date.fromisoformat(str(run_date)).isoformat()


def _flag(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise ValueError(f"Expected true or false, not {text!r}")
    return text.lower() == "true"
