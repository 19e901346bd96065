"""Connected components of a link table by repeated contraction.

Each round every node hooks to its smallest smaller neighbour, parents are
shortened by one jump, and links are renamed to the parents; links inside a
class vanish. Joins on a node that many rows name deal those rows over several
tasks. Rounds are written to the shared folder, so nothing is collected
and lost executors cost at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

#: Tasks that share the rows of one node.
COPIES = 16


def components(links: DataFrame) -> DataFrame:
    """``links`` (``a``, ``b``) -> ``node, root``: the smallest node reachable
    from each node that occurs in a link of two different nodes."""
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = store(links.select(a, b).filter("a < b").distinct(), "links")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = labels.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parents = store(hooks.join(above, "up", "left")
                        .select("node", F.coalesce("top", "up").alias("up")), "parents")
        labels = _renamed(labels, "root", parents)  # one short join per round
        edges = _renamed(_renamed(edges, "a", parents), "b", parents)
        edges = store(edges.select(a, b).filter("a < b").distinct(), "links")
    return labels.select("node", "root")


def spread_join(df: DataFrame, other: DataFrame, key: str, by: str) -> DataFrame:
    """Left join on ``key``, of which ``other`` has every value once and ``df``
    perhaps very often: rows of a value are dealt over ``COPIES`` tasks by ``by``."""
    left = df.withColumn("__copy", F.pmod(F.xxhash64(by), F.lit(COPIES)))
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)).cast("array<bigint>"))
    return left.join(other.withColumn("__copy", copies), [key, "__copy"], "left").drop("__copy")


def _renamed(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    up = parents.select(F.col("node").alias(column), F.col("up").alias("__up"))
    rest = [c for c in df.columns if c != column]
    return spread_join(df, up, column, rest[0]).select(F.coalesce("__up", column).alias(column), *rest)
