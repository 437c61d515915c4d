"""The configured job on a stream: files that have come since the last run are shaped and added to the target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.formats import checked_format
from millrace.paths import overlap, qualified
from millrace.plans.etl import RUN_DATE, FileSource, PipelineSpec, _day, shape
from millrace.sinks.files import _checked, _options
from millrace.sources.files import stream_files


@dataclass(frozen=True)
class StreamResult:
    path: str
    batches: int
    rows_in: int


def run_stream(spark: SparkSession, spec: PipelineSpec, checkpoint: str, files_per_batch: int | None = None) -> StreamResult:
    """Run ``spec`` on what is new below its source, in batches of ``files_per_batch`` files, and end.

    ``checkpoint`` is a folder that remembers which files each batch has. A batch is written once: it counts when the target's log
    names its files, so a run that is killed, at any point, and started again gives what one run would have given. With a
    ``run_date`` a batch goes to the folder of the day; a batch that is run again on another day is in that day's folder alone.

    The result is read as one table at the target's path (:func:`millrace.read_files`), by readers that know the log, as Spark's do; files of
    batches that broke off may lie there and are not part of it. So other jobs must not write there. SQL and steps are those of
    a batch as far as they look at rows one by one; Spark refuses what would need all rows. A target only grows:
    its mode is ``append``, and it is neither sorted, rebalanced nor read back.
    """
    target = spec.target
    if not isinstance(spec.source, FileSource) or not isinstance(spec.source.path, str):
        raise ValueError("A stream reads files below one path")
    if target.mode.lower() != "append" or target.sort_by or target.rebalance or target.verify:
        raise ValueError("A stream appends: mode is append, without sort_by, rebalance or verify")
    checked_format(target.fmt)
    if overlap(qualified(spark, spec.source.path), qualified(spark, target.path)):
        raise ValueError("The stream would read what it writes")
    source = spec.source
    options = {**source.options, **({"maxFilesPerTrigger": files_per_batch} if files_per_batch else {})}
    rows = shape(stream_files(spark, source.path, source.fmt, source.header, source.schema, source.multi_line, options), spec)
    parts = list(target.partition_by)
    if target.run_date is not None:
        if RUN_DATE in [name.lower() for name in rows.columns]:
            raise ValueError(f"The data already has a column {RUN_DATE}")
        rows, parts = rows.withColumn(RUN_DATE, F.lit(_day(target.run_date))), [RUN_DATE, *parts]
    return append_stream(rows, target.path, checkpoint, target.fmt, parts, target.options)


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: Sequence[str] = (), options: dict | None = None
) -> StreamResult:
    """Write all that a stream has now, and end."""
    parts = list(partition_by)
    writer = _checked(rows, parts).writeStream.format(fmt).options(**{**_options(rows, fmt, parts), **(options or {})})
    if parts:
        writer = writer.partitionBy(*parts)
    query = writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
    query.awaitTermination()
    progress = query.recentProgress
    return StreamResult(path, len({p.batchId for p in progress if p.numInputRows}), sum(p.numInputRows for p in progress))
