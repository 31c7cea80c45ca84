"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urnalake.llm.common import written


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Each round gives every node the name of the first node among itself and its neighbours, in a
    hashed order, and renames the edges; edges within a name vanish. A star takes two rounds, and
    the hashed order shrinks chains by a factor per round as well. Hubs are no hot groups: minima
    are taken per task first, and the renaming joins may be split. A round is a written table, so
    no round runs twice and a lost executor costs one round.
    No edges give no rows; null ends are left out.
    """
    clean = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    left = written(clean, purpose)
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        names = written(
            both.groupBy("a").agg(F.min(_ranked("b")).alias("near")).select(
                F.col("a").alias("node"), F.least("near", _ranked("a"))["node"].alias("name")
            ),
            purpose,
        )
        if labels is None:
            labels = names.select("node", F.col("name").alias("label"))
        else:
            renamed = names.select(F.col("node").alias("label"), "name")
            labels = labels.join(renamed, "label", "left").select("node", F.coalesce("name", "label").alias("label"))
        ends_a, ends_b = (names.select(F.col("node").alias(c), F.col("name").alias(f"to_{c}")) for c in "ab")
        moved = left.join(ends_a, "a").join(ends_b, "b").where("to_a <> to_b")
        left = written(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), purpose
        )
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = written(labels, purpose)
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")


def _ranked(name: str) -> Column:
    return F.struct(F.xxhash64(name), F.col(name).alias("node"))
