"""Connected components of an edge table, by rounds of hooking and jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import staged


def _relabel(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """Replace ``column`` by its parent where it has one.  A node may be an end
    of a large share of all edges: a join that adaptive execution splits by
    size, with one parent row for each node."""
    named = parents.select(F.col("node").alias(column), "parent")
    return rows.join(named, column, "left").withColumn(column, F.coalesce("parent", column)).select(*rows.columns)


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) -> (node, component), the smallest node reachable; nodes without
    an edge to another node are left out.  Each round every node takes its
    smallest neighbour as parent, parents are followed twice, and edges are
    drawn between the parents; rounds end when no edge joins two nodes."""
    spark = edges.sparkSession
    both = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = staged(spark, both, "cc-edges")
    labels = None
    while not edges.isEmpty():
        parents = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("parent"))
        for _ in range(2):
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
            parents = parents.join(up, "parent", "left") \
                .select("node", F.coalesce("up", "parent").alias("parent"))
        parents = staged(spark, parents, "cc-parents")
        if labels is None:
            roots = edges.select(F.col("v").alias("node")).distinct().join(parents, "node", "left_anti")
            labels = parents.union(roots.select("node", F.col("node").alias("parent")))
            labels = labels.select("node", F.col("parent").alias("component"))
        else:
            labels = _relabel(labels, "component", parents)
        labels = staged(spark, labels, "cc-labels")
        moved = _relabel(_relabel(edges, "u", parents), "v", parents)
        moved = moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        edges = staged(spark, moved, "cc-edges")
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
