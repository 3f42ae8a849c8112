"""Connected components of a table of links, by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import written
from tidemark.llm.skew import join_groups


def _hung(links: DataFrame) -> DataFrame:
    """Links (u, v) with u's smallest neighbour or u itself, as column m; hubs don't overload a task."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    return join_groups(links, least, "u", "n", "v").select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node on the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return _hung(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    hung = _hung(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    out = hung.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
    return out.where("a < b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or hung on exactly one."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(0).alias("hung")), F.struct(F.col("b").alias("n"), F.lit(1).alias("hung")))).alias("e"))
    seen = ends.groupBy("e.n").agg(F.sum("e.hung").alias("hung"), F.min("e.hung").alias("least"))
    return seen.where((F.col("hung") > 1) | ((F.col("hung") == 1) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the label is the smallest node of its component.

    Each turn is written to the shared folder; it ends when only stars are left. The nodes that
    are their own label are among the rows.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")

    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(roots)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components of nodes labelled so far once further links (a, b) are added: (node, label).

    Only the links between components go through the turns.
    """
    known = labels.select(F.col("node").alias("_node"), "label")

    def named(frame: DataFrame, column: str) -> DataFrame:
        found = frame.join(known, frame[column] == known["_node"], "left")
        return found.withColumn(column, F.coalesce("label", column)).drop("_node", "label")

    between = written(named(named(links, "a"), "b").where("a <> b"), "edges")
    if between.isEmpty():
        return labels
    above = components(between)
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    both = labels.unionByName(
        nodes.join(known, nodes["node"] == known["_node"], "left_anti").select("node", F.col("node").alias("label"))
    )
    up = above.select(F.col("node").alias("label"), F.col("label").alias("_up"), F.lit(1).alias("_n"))
    return join_groups(both, up, "label", "_n", "node").select("node", F.coalesce("_up", "label").alias("label"))
