"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierlake.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the component's smallest node.

    Each round points every node at its smallest neighbour, if that is smaller than itself, follows
    these pointers to their ends (doubling the reach each time), and replaces both ends of every
    edge by what its node leads to. Loops and repeats then go: what is left of a component are its
    local minima. Only one pointer for each node is ever aggregated
    (combined on the map side), and joins have one row for each key on one side, so a hub costs no
    more than its edges. Null ends and loops are ignored.
    """
    edges = materialize(_canonical(edges.select("a", "b")))
    pointers = []
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointer = materialize(ends.groupBy("a").agg(F.min("b").alias("b"))
                              .select(F.col("a").alias("node"), F.least("a", "b").alias("root")))
        moved = True
        while moved:
            further = materialize(_follow(pointer, pointer).withColumnRenamed("root", "end").join(pointer, "node"))
            moved = not further.filter("end <> root").isEmpty()
            pointer = further.select("node", F.col("end").alias("root"))
        pointers.append(pointer)
        left, right = pointer.toDF("a", "x"), pointer.toDF("b", "y")
        edges = materialize(_canonical(
            edges.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))))
    if not pointers:
        return edges.toDF("node", "root")
    found = pointers.pop()
    while pointers:
        found = _follow(pointers.pop(), found)
    return found


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _follow(pointer: DataFrame, onward: DataFrame) -> DataFrame:
    """Replace each root by what ``onward`` has for it, if anything."""
    onward = onward.select(F.col("node").alias("_at"), F.col("root").alias("_to"))
    return (pointer.join(onward, F.col("root") == F.col("_at"), "left")
            .select("node", F.coalesce("_to", "root").alias("root")))
