"""Connected components of an edge table, by hooking on the smallest neighbour and pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.materialize import materialize


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex that is not itself the smallest of its component.

    ``edges`` has the columns a and b, bigint; direction, repetition and loops don't matter.  Each
    round keeps the smallest parent of a vertex, ties its other parents to that one, and replaces
    parents by their parents, so chains halve.  Rounds are written to the shared folder.  Smallest
    parents are combined before the shuffle, and the joins are plain equi-joins that can be split
    where a vertex is hot; nothing is collected but whether a round changed anything.
    """
    forest = edges.where("a <> b").select(
        F.greatest("a", "b").alias("vertex"), F.least("a", "b").alias("parent")
    ).distinct()
    forest = materialize(forest, "links")
    while True:
        lowest = forest.groupBy("vertex").agg(F.min("parent").alias("low"), F.count("*").alias("n"))
        above = lowest.select(F.col("vertex").alias("low"), F.col("low").alias("higher"))
        jumped = lowest.join(above, "low", "left").select(
            "vertex",
            F.coalesce("higher", "low").alias("parent"),
            (F.col("higher").isNotNull() | (F.col("n") > 1)).alias("moved"),
        )
        tied = forest.join(lowest.where("n > 1").select("vertex", "low"), "vertex").where("parent > low")
        tied = tied.select(F.col("parent").alias("vertex"), F.col("low").alias("parent"), F.lit(True).alias("moved"))
        step = jumped.union(tied).groupBy("vertex", "parent").agg(F.max("moved").alias("moved"))
        step = materialize(step, "links")
        forest = step.select("vertex", "parent")
        if step.where("moved").isEmpty():
            return forest.withColumnRenamed("parent", "root")
