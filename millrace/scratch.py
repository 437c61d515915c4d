"""Intermediate tables in the folder that the cluster shares.

A written table cuts lineage and survives the loss of the executors that made it. All of them lie
below one folder per application, which is deleted when the application ends; those made within ``scope``
are deleted when it ends.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from millrace.paths import resolved

_folders: dict[tuple[str, str], str] = {}
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``."""
    key = (scratch_base(spark), spark.sparkContext.applicationId)
    if key not in _folders:
        folder = f"{key[0]}/millrace/{key[1]}-{uuid4().hex}"
        path, fs = resolved(spark, folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _folders[key] = folder
    return "/".join([_folders[key], *_scopes.get(), f"{label}-{uuid4().hex}"])


def scratch_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    # Only where the driver is the executor, as in tests, may the folder be this machine's own.
    if not re.match(r"local($|\[)", spark.conf.get("spark.master", "")):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made within are deleted at its end; results that read them must be written before."""
    name = f"scope-{uuid4().hex}"
    token = _scopes.set((*_scopes.get(), name))
    try:
        yield
    finally:
        own = "/".join([_folders.get((scratch_base(spark), spark.sparkContext.applicationId), ""), *_scopes.get()])
        _scopes.reset(token)
        path, fs = resolved(spark, own)
        fs.delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Reading it back also gives Catalyst the true size, which decides broadcast joins.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
