"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import lookup, stage


def _round(edges: DataFrame, n_edges: int) -> DataFrame:
    """A large and a small star.

    Large: every node hands the smallest of its neighbours and itself to its
    larger neighbours.  A hub may hold most of the links, so the smallest are
    found by partial aggregation and handed back by the skew-safe lookup.
    Small: every node links its smaller neighbours, and itself, to the smallest
    of them; the large star leaves a node few smaller neighbours.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"), F.count(F.lit(1)).alias("n"))
    large = lookup(both, smallest, ["a"], "n", 2 * n_edges).filter("b > a")
    large = large.select(F.col("b").alias("a"), F.col("root").alias("b"))
    small = large.select("a", "b", F.min("b").over(Window.partitionBy("a")).alias("root"))
    ends = F.explode(F.array("a", "b")).alias("a")
    return small.select(ends, "root").filter("a > root").select("a", F.col("root").alias("b")).distinct()


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node of its component.

    Alternates large and small stars until the links no longer change, a number
    of rounds that grows with the logarithm of the longest path; every round is
    written to the shared scratch folder, so lineage stays short.  Three numbers a
    round reach the driver: the links, and two sums of 64-bit hashes of them, which
    repeat only when the links do.  Repeated links and links of a node with itself
    change nothing; a link with a null end is left out; no links give no rows.
    ``rows``: about how many links there are, if known.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
        "links",
        rows,
    )
    seen = None
    while True:
        # Decimals, since a sum of 64-bit numbers may not fit one.
        sums = [F.sum(F.xxhash64(*ends).cast("decimal(20,0)")) for ends in (("a", "b"), ("b", "a"))]
        state = edges.agg(F.count(F.lit(1)), *sums).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        edges = stage(_round(edges, state[0]), "links", state[0])
