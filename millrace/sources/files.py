"""File scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from millrace.formats import CSV_NULL, checked_format


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    header: bool = True,
    schema: StructType | str | None = None,
    multi_line: bool | None = None,
    options: Mapping[str, object] | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Scan CSV, JSON or Parquet files below ``path``.

    Without ``schema`` the types of CSV and JSON are inferred, which reads all of the data once
    more; pass one for large inputs. With ``schema`` a CSV header must agree with it.

    ``multi_line`` lets a CSV field or a JSON document span lines. Such a file is read by a single
    task, so turn it off for large CSV files without line breaks inside fields. It defaults to
    true for CSV and to false for JSON, where each line is one object.

    A row of CSV or JSON that does not fit the columns that are read is an error: too few fields or too many, or a value
    that is not of its type. ``corrupt_column`` keeps such rows instead, as they stand in the file, in a text column
    of that name, which is null for all others. It needs ``schema``, and there is then no check of
    a CSV header.
    """
    return _set(spark.read, fmt, header, schema, multi_line, options, corrupt_column).load(path)


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    header: bool = True,
    schema: StructType | str | None = None,
    multi_line: bool | None = None,
    options: Mapping[str, object] | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """The same files as a stream: each is read once, when it has come. A stream needs a schema."""
    if schema is None:
        raise ValueError("A stream of files needs a schema")
    return _set(spark.readStream, fmt, header, schema, multi_line, options, corrupt_column).load(path)


def _set(
    reader: DataFrameReader | DataStreamReader,
    fmt: str,
    header: bool,
    schema: StructType | str | None,
    multi_line: bool | None,
    options: Mapping[str, object] | None,
    corrupt_column: str | None,
):
    fmt = checked_format(fmt)
    if corrupt_column is not None and (schema is None or fmt == "parquet"):
        raise ValueError("corrupt_column needs CSV or JSON and a schema")
    strict: dict[str, object] = {"mode": "FAILFAST"}
    if corrupt_column is not None:
        shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*shape.fields, StructField(corrupt_column, StringType())])
        strict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    if fmt == "csv":
        reader = reader.options(
            header=header,
            multiLine=True if multi_line is None else multi_line,
            escape='"',
            nullValue=CSV_NULL,
            inferSchema=schema is None,
            enforceSchema=schema is None or not header or corrupt_column is not None,
            **strict,
        )
    elif fmt == "json":
        reader = reader.options(multiLine=bool(multi_line), **strict)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).format(fmt)
