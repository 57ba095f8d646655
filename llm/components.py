"""Connected components of a table of links, without collecting any."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sieveframe.sources.scratch import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node can reach.

    ``links`` has the long columns a and b. Alternates two steps until nothing changes:
    each node hands its larger neighbours to its smallest one, then its smaller ones.
    The longest path shrinks by a constant factor each time. Both steps aggregate before
    they shuffle, but the links of one node are then joined with its least neighbour by
    the node, so those of a node with very many links go to one task, unless Spark splits
    the skewed join. Each round is written to the shared folder and read again, which
    cuts the lineage.
    """
    edges, before = _settled(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while before["n"]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, F.col("v") > F.col("u"))
        edges, now = _settled(_star(edges, F.lit(True), own=True))
        if now == before:
            break
        before = now
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionAll(roots)


def _star(edges: DataFrame, which, own: bool = False) -> DataFrame:
    """Links of each node's chosen neighbours, and with ``own`` its own, to the least."""
    least = edges.groupBy(F.col("u").alias("w")).agg(
        F.least(F.min("v"), F.min("u")).alias("least")
    )
    near = edges.filter(which).join(least, F.col("u") == F.col("w"))
    out = near.select(F.col("v").alias("u"), F.col("least").alias("v"))
    if own:
        out = out.unionAll(least.select(F.col("w").alias("u"), F.col("least").alias("v")))
    # Links that are there twice go with the step that ends a round.
    return out.filter("u <> v").distinct() if own else out.filter("u <> v")


def _settled(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The links, written, with their number and a sum over hashes of all of them."""
    seen = Observation()
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    watched = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(mark).alias("mark"))
    kept = settle(watched, "links")
    return kept, seen.get
