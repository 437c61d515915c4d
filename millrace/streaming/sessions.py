"""Sessions of a stream of events, with a watermark and without losing late rows.

Spark drops rows that come after the watermark has passed them. So the stream is split first, by a query that sees the
watermark but drops nothing: what comes too late goes to a folder of its own, what comes in time to another one. The sessions are
made from the latter by Spark's own session windows, whose state is in the checkpoint. Their watermark follows that of the first
query and is never ahead of it, so nothing is dropped there.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, MapType, StringType, StructField, StructType, TimestampType

from millrace.formats import TIMESTAMP_FORMATS
from millrace.operators.spread import unused, with_hashes
from millrace.streaming.jobs import StreamResult, append_stream

LATE = "late"

#: Groups that rows are dealt to while they are split: by a hash of the row, as no row has to meet another one.
SPREAD = 64

_PLAIN = (StringType, BinaryType, BooleanType)


def split_late(events: DataFrame, time: str, delay: str) -> DataFrame:
    """A stream's rows with a column ``late``: is ``time`` before the watermark, the latest time of the batches before less ``delay``?

    ``time`` is a timestamp; the first batch has the watermark 1970. A row without time is late, as it has no place in any session. The rows of a batch do not judge each other: a batch
    may come in any order. Nested columns go through JSON, so keys of maps are to be texts.
    """
    if events.schema[time].dataType.simpleString() != "timestamp":
        raise TypeError(f"{time} is to be a timestamp")
    if LATE in [c.lower() for c in events.columns]:
        raise ValueError(f"The data already has a column {LATE}")
    rows, tie = with_hashes(events)
    group, mark, clock = (unused([*rows.columns, LATE], f"__{part}") for part in ("group", "micros", "clock"))
    # The watermark column goes to pandas as it is, which knows the years from 1678 to 2261.
    known = F.least(F.greatest(_named(time), F.timestamp_seconds(F.lit(-9_000_000_000))), F.timestamp_seconds(F.lit(9_000_000_000)))
    rows = rows.withColumn(clock, F.when(_named(time).isNotNull(), known)).withWatermark(clock, delay)
    # As texts, because pandas knows no nulls among numbers and no times of the far past.
    packed = [_packed(c).alias(c.name) for c in events.schema]
    rows = rows.select(F.pmod(F.col(tie), F.lit(SPREAD)).alias(group), F.unix_micros(_named(time)).cast("string").alias(mark), clock, *packed)
    shape = StructType([*[c for c in rows.schema if c.name not in (group, mark, clock)], StructField(LATE, BooleanType())])

    def told(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bound = state.getCurrentWatermarkMs() * 1000
        for batch in batches:
            late = [micros is None or int(micros) < bound for micros in batch[mark]]
            yield batch.drop(columns=[group, mark, clock]).assign(**{LATE: late})

    unused_state = StructType([StructField("none", BooleanType())])
    split = rows.groupBy(group).applyInPandasWithState(told, shape, unused_state, "append", GroupStateTimeout.NoTimeout)
    return split.select(*[_unpacked(c).alias(c.name) for c in events.schema], LATE)


def _packed(column: StructField) -> Column:
    value, kind = _named(column.name), column.dataType
    if isinstance(kind, _PLAIN):
        return value
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false", **TIMESTAMP_FORMATS})
    return (F.unix_micros(value) if isinstance(kind, TimestampType) else value).cast("string")


def _unpacked(column: StructField) -> Column:
    value, kind = _named(column.name), column.dataType
    if isinstance(kind, _PLAIN):
        return value
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.from_json(value, StructType([StructField("v", kind)]), {"mode": "FAILFAST", **TIMESTAMP_FORMATS})["v"]
    return F.timestamp_micros(value.cast("long")) if isinstance(kind, TimestampType) else value.cast(kind)


def stream_sessions(
    events: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str],
    time: str,
    gap: str,
    delay: str,
    sums: Sequence[str] = (),
) -> Mapping[str, StreamResult]:
    """Read all that the stream has now into three tables below ``path``, and end.

    ``events/late=false`` holds the rows that came in time, ``events/late=true`` those that came too late (read ``events`` as
    one table); ``sessions`` holds the sessions whose end the watermark has passed, each once: see :func:`batch_sessions` for their columns.
    They are the sessions of all rows in time, however these were cut into batches. Sessions that may still grow are
    in the checkpoint and come with a later run. A run that is killed may be started again, as in :func:`run_stream`.
    """
    spark: SparkSession = events.sparkSession
    path, checkpoint = path.rstrip("/"), checkpoint.rstrip("/")
    split = append_stream(split_late(events, time, delay), f"{path}/events", f"{checkpoint}/events", partition_by=[LATE])
    shape = StructType([*events.schema.fields, StructField(LATE, BooleanType())])
    kept = spark.readStream.schema(shape).parquet(f"{path}/events").where(~F.col(LATE)).withWatermark(time, delay)
    found = append_stream(_sessions(kept, by, time, gap, sums), f"{path}/sessions", f"{checkpoint}/sessions")
    return {"events": split, "sessions": found}


def batch_sessions(events: DataFrame, by: Sequence[str], time: str, gap: str, sums: Sequence[str] = ()) -> DataFrame:
    """``by``, ``session_start``, ``session_end`` (the last event's time plus ``gap``), ``rows``, and the sums by name.

    Events of a group are in one session if no more than ``gap`` lies between neighbours. Rows without time are in none.
    """
    return _sessions(events, by, time, gap, sums)


def _sessions(events: DataFrame, by: Sequence[str], time: str, gap: str, sums: Sequence[str]) -> DataFrame:
    window = F.session_window(_named(time), gap)
    counts: list[Column] = [F.count(F.lit(1)).alias("rows"), *[F.sum(_named(c)).alias(c) for c in sums]]
    found = events.groupBy(*map(_named, by), window).agg(*counts)
    span = {"session_start": F.col("session_window.start"), "session_end": F.col("session_window.end")}
    return found.select(*map(_named, by), *[v.alias(k) for k, v in span.items()], "rows", *map(_named, sums))


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")
