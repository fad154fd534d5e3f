"""Connected components of an undirected graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns a, b of one type): the smallest node reachable.

    Rounds of two steps: every node links its larger neighbours to its smallest one, then every node links its
    smaller neighbours, and itself, to its smallest one. Neither gathers a node's neighbours: minima are combined
    before the shuffle, and the rows of a node with very many neighbours are a join side that can be split. The rounds
    end when the links are stars around each component's smallest node. Loops and repeated rows add nothing.
    """
    links = stored(_ordered(edges.select("a", "b")), label)
    while not _are_stars(links):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(_ordered(large), label)
        # Now a > b in every row: b are the smaller neighbours of a.
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        small = links.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = stored(_ordered(small), label)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct rows with the larger node first."""
    return edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller node at most, and then none from a larger one."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(links.select("b", F.lit(0), F.lit(1)))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up > 1 or (up = 1 and down = 1)").isEmpty()
