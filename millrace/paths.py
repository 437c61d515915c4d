"""What the file system and a plan say about paths."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def resolved(spark: SparkSession, path: str):
    """``path`` as a Hadoop path, and the file system it lies on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and without relative parts, as Spark itself resolves it."""
    hadoop_path, fs = resolved(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = resolved(spark, path)
    return fs.exists(hadoop_path)


def overlap(one: str, other: str) -> bool:
    a, b = one.rstrip("/") + "/", other.rstrip("/") + "/"
    return a.startswith(b) or b.startswith(a)


def read_paths(df: DataFrame) -> list[str]:
    """Root paths of all file scans in ``df``, subqueries included.

    They come in one call per scan: a glob has a root path for every file it matches. Scans that are not Spark's own
    file relations (other table formats, the newer file readers) say nothing about their paths and are not seen.
    """
    analyzed = df._jdf.queryExecution().analyzed()
    paths = []
    for plan in [analyzed, *_items(analyzed.subqueriesAll())]:
        for leaf in _items(plan.collectLeaves()):
            if leaf.nodeName().startswith("LogicalRelation"):
                relation = leaf.relation()
                if relation.getClass().getSimpleName() == "HadoopFsRelation":
                    roots = relation.location().rootPaths().mkString("\0")
                    paths += roots.split("\0") if roots else []
    return paths


def _items(seq) -> Iterable:
    return (seq.apply(i) for i in range(seq.size()))
