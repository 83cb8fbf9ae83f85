"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(v, component) of every vertex in ``links`` (a, b): the smallest vertex reachable.

    Each round every vertex points at its smallest neighbour, pointers are
    followed twice, and links are rewritten to the vertices pointed at; the
    smallest vertex of a component always keeps its own name. Groups only take
    minima (combined before the shuffle), so a vertex with many links is no
    special case. Null ends, loops and repeated links are ignored; no links, no rows.
    """
    ends = links.select("a", "b").where(F.col("a") != F.col("b"))
    open_links = staged(
        ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    found = None
    while found is None or not open_links.isEmpty():
        both = open_links.unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("n"))
        near = near.select(F.col("a").alias("v"), F.least("a", "n").alias("p"))
        near = staged(near, "pointers")
        jumped = near.join(near.select(F.col("v").alias("p"), F.col("p").alias("q")), "p")
        step = staged(jumped.select("v", F.col("q").alias("p")), "jumps")
        if found is None:
            found = step.select("v", F.col("p").alias("component"))
        else:
            moved = step.select(F.col("v").alias("component"), "p")
            found = found.join(moved, "component", "left").select(
                "v", F.coalesce("p", "component").alias("component")
            )
        start = step.select(F.col("v").alias("a"), F.col("p").alias("x"))
        end = step.select(F.col("v").alias("b"), F.col("p").alias("y"))
        rest = open_links.join(start, "a").join(end, "b").where(F.col("x") != F.col("y"))
        open_links = staged(
            rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links",
        )
    return found
