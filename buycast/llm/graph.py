"""Connected components of an edge table, by alternating large and small stars."""

from pyspark.sql import functions as F

from buycast.llm.common import stored


def _state(edges):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def _star(edges, small):
    """Link the larger (large star) or smaller (small star) neighbours of each node to its least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if small:
        both = both.filter("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
    else:
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        both = both.filter("v > u")
    linked = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        linked = linked.union(least.select("u", F.col("m").alias("v")))
    return linked.filter("u <> v").distinct()


def components(edges):
    """(node, root) for every node of ``edges`` (columns u, v, any order): root is the least node reachable.

    Each round is two aggregations and two joins, cut by a written table; paths shrink by a constant
    factor or better per round. Minima are taken before the shuffle, so a node with many edges costs one
    row per task, and joins on it may be split. No edges: no rows.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = stored(_star(stored(_star(edges, small=False)), small=True))
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
