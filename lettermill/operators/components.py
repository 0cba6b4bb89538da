"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import Scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """``(v, comp)`` for every vertex of ``edges (i, j)``; ``comp`` is the smallest vertex.

    Smallest labels travel along edges, and each round every vertex also takes its label's label, so
    the rounds grow with the logarithm of the longest chain. Messages are reduced by a map-side
    combined minimum. Rounds are written to the shared folder.
    """
    scratch = Scratch(edges.sparkSession, "components")
    e = edges.where("i <> j").select(F.explode(F.array(F.struct(F.col("i").alias("v"), F.col("j").alias("w")), F.struct(F.col("j").alias("v"), F.col("i").alias("w")))).alias("e"))
    e = scratch.cut(e.select("e.v", "e.w").distinct())
    labels = scratch.cut(e.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("comp")))
    while True:
        told = e.join(labels.select(F.col("v").alias("w"), "comp"), "w").groupBy("v").agg(F.min("comp").alias("m"))
        near = labels.join(told, "v").select("v", F.least("comp", "m").alias("n"), F.col("comp").alias("old"))
        jump = labels.select(F.col("v").alias("n"), F.col("comp").alias("up"))
        new = scratch.cut(near.join(jump, "n").select("v", F.least("n", "up").alias("comp"), "old"))
        scratch.drop(labels)
        labels = new.select("v", "comp")
        if new.where("comp <> old").isEmpty():
            return labels
