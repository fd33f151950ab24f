"""Connected components of a table of links, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hausprep.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``id, root`` of every node of ``links(a, b)``; the root is the least id of the component.

    Each round every node points to the least of itself and its neighbours, pointers are followed twice, and
    the links are rewritten to the nodes pointed to; those within one node go.  Links and nodes shrink by
    half or more each round, and each round is written to the shared folder, so lineage stays short.
    """
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = materialize(both.groupBy("a").agg(F.min("b").alias("least"))
                        .select(F.col("a").alias("id"), F.least("a", "least").alias("root")), "roots")
    step = roots
    while True:
        up = step.select(F.col("id").alias("root"), F.col("root").alias("above"))
        step = materialize(step.join(up, "root", "left").select("id", F.coalesce("above", "root").alias("root")), "step")
        roots = materialize(roots.join(step.select(F.col("id").alias("root"), F.col("root").alias("above")), "root", "left")
                            .select("id", F.coalesce("above", "root").alias("root")), "roots")
        to = step.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        edges = edges.join(to, "a", "left").select(F.coalesce("ra", "a").alias("a"), "b")
        edges = edges.join(to.withColumnsRenamed({"a": "b", "ra": "rb"}), "b", "left") \
            .select("a", F.coalesce("rb", "b").alias("b"))
        edges = materialize(edges.where("a <> b").distinct(), "links")
        if edges.isEmpty():
            return roots
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = materialize(both.groupBy("a").agg(F.min("b").alias("least"))
                           .select(F.col("a").alias("id"), F.least("a", "least").alias("root")), "step")
        roots = materialize(roots.join(step.select(F.col("id").alias("root"), F.col("root").alias("above")), "root", "left")
                            .select("id", F.coalesce("above", "root").alias("root")), "roots")
