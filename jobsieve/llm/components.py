"""Connected components of a distributed edge list."""

from pyspark.sql import functions as F

from .common import stored


def _state(edges):
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(edges, u="u", v="v"):
    """(node, component) for every node of an edge, the component being its smallest node.

    Alternating large and small stars: every round hangs neighbours on the smallest one they know. Minima are
    combined before the shuffle, and the joins back are ones that adaptive execution can split, so a node with very many
    neighbours does no harm. Each round is written to the shared folder.
    """
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: greater neighbours of u hang on the smallest node around u.
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours hang on the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small, "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
