"""Greedy ordered cover: the sequential 'take it unless an earlier one is near' rule in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.session import cut_lineage


def greedy_heads(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Heads chosen in the order of `ord` (unique), an adjacent later node being dropped.

    nodes(id, ord), pairs(a, b) in both directions. A node is a head once all earlier
    neighbours are known not to be; it drops out once one of them is a head. The outcome
    equals the sequential pass whatever the partitioning.
    """
    order = nodes.select("id", "ord")
    earlier = (
        pairs.join(order.withColumnRenamed("id", "a").withColumnRenamed("ord", "oa"), "a")
        .join(order.withColumnRenamed("id", "b").withColumnRenamed("ord", "ob"), "b")
        .filter("ob < oa")
        .select(F.col("a").alias("id"), F.col("b").alias("before"))
        .distinct()
    )
    earlier = cut_lineage(earlier)
    todo = cut_lineage(order.select("id"))
    heads = None
    while not todo.isEmpty():
        open_pairs = earlier.join(todo, "id", "left_semi")
        waiting = open_pairs.join(todo.withColumnRenamed("id", "before"), "before", "left_semi").select("id").distinct()
        new = cut_lineage(todo.join(waiting, "id", "left_anti"))
        heads = new if heads is None else heads.unionByName(new)
        covered = earlier.join(new.withColumnRenamed("id", "before"), "before", "left_semi").select("id").distinct()
        todo = cut_lineage(todo.join(new, "id", "left_anti").join(covered, "id", "left_anti"))
    return heads if heads is not None else order.select("id")
