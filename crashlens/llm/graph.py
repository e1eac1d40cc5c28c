"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.tables import remove, written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every id in ``links`` (``a``, ``b``); the component is its smallest id.

    Contraction: each round every vertex points to its smallest neighbour, a
    step of pointer jumping shortens the chains, and links are relabelled with
    what their ends point to; links inside one label vanish. The number of
    vertices at least halves each round, so rounds grow with the logarithm of
    the longest chain. Nothing is collected but the number of links left.
    All joins are between two written tables, so that Spark can split the rows
    of a vertex with very many links.
    """
    ends = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = written(ends, f"{name}-links")
    ids = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = written(ids.select("id", F.col("id").alias("component")), f"{name}-labels")
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("to")), f"{name}-point")
        further = point.select(F.col("id").alias("to"), F.col("to").alias("to2"))
        jump = written(point.join(further, "to", "left").select("id", F.coalesce("to2", "to").alias("to")), f"{name}-jump")
        on = jump.select(F.col("id").alias("component"), "to")
        moved = written(labels.join(on, "component", "left").select("id", F.coalesce("to", "component").alias("component")), f"{name}-labels")
        a, b = jump.select(F.col("id").alias("a"), F.col("to").alias("a2")), jump.select(F.col("id").alias("b"), F.col("to").alias("b2"))
        rest = (
            left.join(a, "a").join(b, "b").where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        )
        rest = written(rest, f"{name}-links")
        remove(left, labels, point, jump)
        left, labels = rest, moved
    remove(left)
    return labels
