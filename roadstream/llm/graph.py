"""Connected components of a graph given as rows of edges, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from roadstream.shared import freeze


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    Each round links the larger neighbours of a node to its smallest neighbour, then the smaller ones.  A node with
    many neighbours is met by a join on its smallest one, never gathered in one list.
    """
    def distinct(links):
        return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def settled(links):
        """Whether each node has one link, to a node without links of its own."""
        total, nodes = links.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
        return total == nodes and not links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").head(1)

    links = freeze(distinct(edges.select("a", "b")), "links")
    for _ in range(rounds):
        if settled(links):
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = freeze(distinct(large), "links")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        links = freeze(distinct(small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))), "links")
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
