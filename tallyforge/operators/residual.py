"""Whole percentages of a few groups, the second being what the first leaves of 100."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def residual_percent(groups: DataFrame) -> DataFrame:
    """Apply the residual rule to (criterion, grp, share, first_seen) rows.

    Groups of a criterion stand in ``first_seen`` order.  The first whose truncated share is not 0
    keeps it, the next one gets 100 minus it, the rest get 0.  Adds ``position`` and
    ``residual_pct``.  The windows see one row per label of a criterion, never users or events.
    """
    ordered = Window.partitionBy("criterion").orderBy("first_seen", "grp")
    whole = Window.partitionBy("criterion")
    placed = groups.withColumn("position", F.row_number().over(ordered)).withColumn(
        "_whole", F.col("share").cast("bigint")
    )
    leader = F.min(F.when(F.col("_whole") != 0, F.col("position"))).over(whole)
    led = placed.withColumn("_leader", leader)
    leading = F.max(F.when(F.col("position") == F.col("_leader"), F.col("_whole"))).over(whole)
    return (
        led.withColumn("_leading", leading)
        .withColumn(
            "residual_pct",
            F.when(F.col("position") == F.col("_leader"), F.col("_leading"))
            .when(F.col("position") == F.col("_leader") + 1, F.lit(100) - F.col("_leading"))
            .otherwise(F.lit(0))
            .cast("bigint"),
        )
        .drop("_whole", "_leader", "_leading")
    )
