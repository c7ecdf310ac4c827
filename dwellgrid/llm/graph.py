"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its smallest node.

    In each round every node joins the neighbour (or itself) with the smallest hash, and the links
    are carried over to the chosen nodes, until none is left. A chain shrinks by a constant share
    as a star does, so rounds grow with the logarithm of the longest path. Each round is two
    joins and a minimum that is combined map-side; tables are written, so lineage stays short.
    """
    links = written(
        links.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").filter("a != b").distinct(),
        "links",
    )
    label, turn = None, 0
    while True:
        both = links.union(links.select("b", "a")).toDF("u", "v")
        chosen = both.groupBy("u").agg(
            F.min(F.struct(F.xxhash64("v", F.lit(turn)).alias("h"), "v")).alias("best")
        )
        own = F.struct(F.xxhash64("u", F.lit(turn)).alias("h"), F.col("u").alias("v"))
        step = written(chosen.select("u", F.least("best", own)["v"].alias("p")), "contraction")
        if label is None:
            label = step.select(F.col("u").alias("node"), "p")
        else:
            label = label.join(step.toDF("p", "q"), "p", "left").select(
                "node", F.coalesce("q", "p").alias("p")
            )
        links = written(
            links.join(step.toDF("a", "pa"), "a")
            .join(step.toDF("b", "pb"), "b")
            .selectExpr("least(pa, pb) AS a", "greatest(pa, pb) AS b")
            .filter("a != b")
            .distinct(),
            "links",
        )
        turn += 1
        if links.isEmpty():
            break
    label = written(label, "labels")
    smallest = label.groupBy("p").agg(F.min("node").alias("component"))
    return label.join(smallest, "p").select("node", "component")
