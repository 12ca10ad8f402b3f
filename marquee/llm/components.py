"""Connected components of an edge table, by alternating stars.

Each round points every node's larger neighbours at its smallest one (large star),
then every node and its smaller neighbours at the smallest (small star), until
the edges no longer change. Rounds grow with the logarithm of the longest chain;
every round is a few joins and pre-aggregated minimums, and is stored, so a lost
executor repeats one round's tasks only. Nothing is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import merged, stored


EDGES_A_TASK = 1_000_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", by_size: bool = False) -> DataFrame:
    """(node, component) for every node of an edge between two nodes; component: its smallest node.

    Null ends and edges from a node to itself are ignored; repeated edges count once. ``by_size``: the tasks of a
    round follow the number of edges (``EDGES_A_TASK``, at least one per core, at most the shuffle partitions),
    so that rounds over few edges do not cost hundreds of nearly empty tasks. Joins with many nodes, those with the
    result included, are merges (``merged``).
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    if by_size:
        return _components_by_size(now)
    now = stored(now, "edges", rebalance=True)
    state = _state(now)
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        nodes = 2 * state[0]
        large = (both.filter("v > u").join(merged(least, nodes), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(merged(least, nodes), "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = stored(small, "stars", rebalance=True)
        before, state = state, _state(now)
        if state == before:
            break
    return _labels(now, state[0])


def _labels(stars: DataFrame, edges: int) -> DataFrame:
    labels = stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    return merged(labels, 2 * edges)


def tasks_for(rows: int, df: DataFrame, a_task: int = EDGES_A_TASK) -> int:
    """Tasks for a table of so many rows."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(df.sparkSession.sparkContext.defaultParallelism, rows // a_task), most)


def _components_by_size(edges: DataFrame) -> DataFrame:
    """The same rounds; every stage ends in as many tasks as its edges need (a narrow step, no shuffle)."""
    now = stored(edges, "edges")
    state = _state(now)
    while state[0]:
        n = tasks_for(state[0], now)
        now = now.coalesce(n)
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(n)
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        nodes = 2 * state[0]
        large = (both.filter("v > u").join(merged(least, nodes), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").coalesce(n).distinct().coalesce(n))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(merged(least, nodes), "u").coalesce(n)
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(joined.select("u", F.col("m").alias("v"))).filter("u <> v").coalesce(n).distinct().coalesce(n))
        now = stored(small, "stars")
        before, state = state, _state(now)
        if state == before:
            break
    return _labels(now, state[0])


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())
