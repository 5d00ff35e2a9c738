"""Connected components of a link table by contraction: every node takes the
smallest id among itself and its neighbours, links are rewritten to those ids,
and the rounds go on over the links that still join two. Each round is a
pre-aggregated group-by and two joins over narrow rows, written under the
shared checkpoint folder. Ids should be hashes: then no chain is sorted and
the number of rounds grows with the logarithm of a chain's length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrail.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``v, c`` for every node of ``links`` (long columns ``a``, ``b``): nodes
    share ``c`` exactly if they are connected."""
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                           .select(F.col("a").alias("x"), F.least("a", "m").alias("r")), "step")
        if labels is None:
            labels = step.select(F.col("x").alias("v"), F.col("r").alias("c"))
        else:
            labels = materialize(labels.join(step, labels["c"] == step["x"], "left")
                                 .select("v", F.coalesce("r", "c").alias("c")), "labels")
        left = step.select(F.col("x").alias("a"), F.col("r").alias("ra"))
        right = step.select(F.col("x").alias("b"), F.col("r").alias("rb"))
        edges = materialize(edges.join(left, "a").join(right, "b").where("ra <> rb")
                            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                            .distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
    return labels
