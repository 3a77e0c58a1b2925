"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesline.session import cut_lineage


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
    return row.n, row.h


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): every node of a link (columns a and b) with the smallest node of its component.

    Large and small star steps alternate until nothing changes: in the one every node's larger neighbours, in
    the other its smaller ones, are tied to the smallest neighbour. The number of links never grows, minima are
    taken before rows move, and each round is stored in the shared folder. Loops and repeated links do no harm.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = cut_lineage(edges)
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        if not now[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.where("a <> b").distinct())  # a > b holds for every pair
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        tied = large.join(least, large["a"] == least["u"])
        small = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(tied.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.where("a <> b").distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
