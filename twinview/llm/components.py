"""Connected components of a graph given by its links, by stars that get larger and smaller in turn.

Each round links every node to the least of its neighbours and passes the neighbours on; after
some rounds, their number the logarithm of the longest path, each component is a star around its
least node. A node with very many links is summed before its shuffle, and met again by a join
that Spark splits. Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinview.session import new_table_dir

MAX_ROUNDS = 60


def _written(df: DataFrame) -> DataFrame:
    path = new_table_dir(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    """Links (u, v), v < u: every neighbour above u, and u, to the least of u and its neighbours."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
        least.where("m < u").select("u", F.col("m").alias("v"))).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links (u, v), v < u: u and its neighbours below to the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
        least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, component) of every node with a link (a, b); the component is its least node.

    Links may be in either direction and repeated; those with a null or from a node to itself do
    not count, so that a node with no others has no row. RuntimeError if it isn't done within
    ``max_rounds``, which no graph of fewer than 2 ** max_rounds nodes needs.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = _written(links)
    before = None
    for _ in range(max_rounds):
        links = _written(_small_star(_large_star(links)))
        # a star's links end at nodes that begin none, and are the same in number and sum as before
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
        before = now
    raise RuntimeError("the components are not found")
