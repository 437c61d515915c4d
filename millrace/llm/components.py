"""Connected components of a table of links, by rounds of joins.

Each round links every vertex's larger neighbours to the smallest of its neighbourhood (large star),
then its smaller neighbours likewise (small star), until nothing changes. Every round is written
to the shared scratch folder, so lineage stays short and a lost executor costs one round at most. A
vertex with very many links is summed by partial aggregation; the sums are written too, so that the join
with them has a plain scan on both sides and Spark can split such a vertex. No neighbourhood is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex`` and ``root`` (the smallest vertex reachable) for each vertex of a link between two.

    Nulls: a link with a null end joins nothing and is left out, as are links of a vertex to itself.
    Links may repeat and point either way. An empty table gives an empty result.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialize(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "links")
    before = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
            )
        before = now


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("at", "other")
    least = materialize(both.groupBy("at").agg(F.least(F.min("other"), F.col("at")).alias("m")), "least")
    return both.where("other > at").join(least, "at").select(F.col("other").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()
