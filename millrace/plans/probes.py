"""Checks that sources can be read and targets written."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.files import write_files

_SCHEMA = "source string, status string, n long, error string, rows array<string>"


def probe_sources(
    spark: SparkSession,
    probes: Mapping[str, Callable[[], DataFrame]],
    parallel: int = 4,
    limit: int = 5,
    columns: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The first ``limit`` rows of each named frame; one row per source says ``ok`` or ``failed`` and why.

    ``n`` is the number of rows seen, ``rows`` holds them as JSON. ``columns`` names, per source, the columns to read;
    only these are. Nothing is counted: a task stops as soon as it has enough rows, so a probe of
    files or of a database is small whatever it probes. A source that fails does not stop the others. Each
    probe is a job of its own, and ``parallel`` of them run at a time.
    """

    def seen(name: str) -> list[str]:
        df = probes[name]()
        chosen = (columns or {}).get(name)
        df = df if chosen is None else df.select(*chosen)
        return [row[0] for row in df.limit(limit).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        found = pool.map(lambda name: _outcome(name, lambda: seen(name)), probes)
        return spark.createDataFrame(list(found), _SCHEMA)


def probe_target(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Write two rows that name this run to ``path``, replacing what is there, and count them; the row as above.

    Give it a path kept for this check.
    """

    def written() -> list[str]:
        marks = spark.range(2).select("id", F.lit(uuid4().hex).alias("run"))
        write_files(marks, path, fmt, verify=True)
        return [row[0] for row in marks.select(F.to_json(F.struct("*"))).collect()]

    return spark.createDataFrame([_outcome(path, written)], _SCHEMA)


def _outcome(name: str, rows: Callable[[], list[str]]) -> tuple[str, str, int | None, str | None, list[str] | None]:
    try:
        found = rows()
        return name, "ok", len(found), None, found
    except Exception as error:  # whatever is raised is the finding
        return name, "failed", None, f"{type(error).__name__}: {error}".splitlines()[0], None
