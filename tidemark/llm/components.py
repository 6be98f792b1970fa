"""Connected components of a table of links, by alternating stars.

Every node is linked to the least node it knows: first all larger neighbours of a node to its
least neighbour, then all smaller ones. Paths shorten by about half each round, so the number
of rounds follows the logarithm of the longest path, and links that are stars already need
none. Each round is written to the shared folder, which cuts the lineage; nothing but one
count a round reaches the driver. The least neighbours are written before they are joined
back, so that both sides of the join are plain exchanges and adaptive execution can split a
node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links ``a > b`` replaced by links to the least of each node's neighbours."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = written(least, "star-least")
    joined = both.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a != b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether ``links`` are stars: every node has one link upwards at most, to a node with
    none. Nodes are summed map-side, so a busy one crosses the shuffle once per task."""
    ends = links.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").count() == 0


def connected(links: DataFrame) -> DataFrame:
    """``id, root`` for every node of ``links`` (``a``, ``b``) but the roots themselves:
    the least node its links lead to. Self-links and nulls are ignored; links may repeat."""
    links = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while not _settled(links):
        links = written(_star(written(_star(links, True), "star-large"), False), "star-small")
    return links.select(F.col("a").alias("id"), F.col("b").alias("root"))
