"""Connected components of a graph given by its edges, by repeated contraction.

In each round every node goes to the neighbour that comes first in some order (or stays), and the
edges are carried over to where their ends went. The order is by id and, in every other round, drawn
anew: then a constant share of the nodes goes away whatever the shape of the components, long chains
too. What each round decided is a stored table; in the end the rounds are followed back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.scratch import stored


def _order(node: str, rounds: int):
    """By id in every other round: links to the first of a group go at once."""
    drawn = F.xxhash64(node, F.lit(rounds)) if rounds % 2 else F.lit(0).cast("long")
    return F.struct(drawn.alias("drawn"), F.col(node).alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all nodes of the edges (a, b): the smallest id of the component.

    Edges to oneself and repeated edges do no harm; edges with a null end are left out.
    """
    edges = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        order = _order("there", len(rounds))
        ends = edges.select(F.col("a").alias("id"), F.col("b").alias("there")).union(
            edges.select(F.col("b"), F.col("a"))
        )
        chosen = ends.groupBy("id").agg(F.min(order)["node"].alias("there"))
        own = _order("id", len(rounds))
        goes = stored(
            chosen.select(
                "id", F.when(own < order, F.col("id")).otherwise(F.col("there")).alias("to")
            ),
            "contraction",
        )
        rounds.append(goes)
        edges = stored(
            edges.join(goes.select(F.col("id").alias("a"), F.col("to").alias("a_to")), "a")
            .join(goes.select(F.col("id").alias("b"), F.col("to").alias("b_to")), "b")
            .where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            "edges",
        )
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = rounds[-1]
    for goes in reversed(rounds[:-1]):
        later = roots.select(F.col("id").alias("to"), F.col("to").alias("root"))
        roots = goes.join(later, "to", "left").select(
            "id", F.coalesce("root", "to").alias("to")
        )
    roots = stored(roots, "roots")
    smallest = roots.groupBy("to").agg(F.min("id").alias("component"))
    return stored(roots.join(smallest, "to").select("id", "component"), "components")
