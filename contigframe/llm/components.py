"""Connected components by contraction, as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigframe.llm import util


def components(edges: DataFrame, tmp: util.Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of an edge, the smallest node of its component, as a table in ``tmp``.

    Each round every node moves to its first neighbour, if that comes before itself, edges follow, and those inside one node go; what is
    left is a smaller graph, so rounds end by themselves. In the first rounds order is that of the ids, which settles stars at once; later
    it is a hash that changes each round, so of any long chain about a third of the nodes goes each time. Nodes with very many edges
    and roots with very many nodes meet their moves by broadcast. The driver sees only whether edges are left.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    pairs = tmp.written(_directed(pairs), "edges")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots, k = tmp.written(both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "roots"), 0
    while pairs.limit(1).count():
        rank = lambda c, k=k: F.struct((util.mix(k, F.col(c)) if k >= 2 else F.lit(0).cast("long")).alias("h"), F.col(c).alias("n"))
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        move = tmp.written(first.select("a", F.least(rank("a"), F.col("m"))["n"].alias("to")), "moves")
        roots = util.join_heavy(roots, move.withColumnRenamed("a", "root"), ["root"], "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = tmp.written(roots, "roots")
        moved = tmp.written(util.join_heavy(pairs, move, ["a"]).select(F.col("to").alias("a"), "b"), "moved")
        moved = util.join_heavy(moved, move.select(F.col("a").alias("b"), F.col("to").alias("to_b")), ["b"]).select("a", F.col("to_b").alias("b"))
        pairs, k = tmp.written(_directed(moved.where("a <> b")), "edges"), k + 1
    if k > 2:  # roots are then any node: name components by their smallest
        least = roots.groupBy("root").agg(F.min("node").alias("least"))
        roots = tmp.written(util.join_heavy(roots, least, ["root"]).select("node", F.col("least").alias("root")), "roots")
    return roots


def _directed(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
