"""One row per key, chosen by a total order, as an aggregate.

A ranking window would gather a whole key in one task.  Taking the smallest ordered struct instead
keeps one candidate per key and map task before the shuffle, so a key that holds a third of all
rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in ascending ``order``; full ties give the same row anyway."""
    ranks = [F.col(o) if isinstance(o, str) else o for o in order]
    kept = [c for c in df.columns if c not in keys]
    ranked = df.select(
        *[F.col(f"`{k}`") for k in keys],
        F.struct(
            *[rank.alias(f"_{i}") for i, rank in enumerate(ranks)],
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        ).alias("_first"),
    )
    best = ranked.groupBy(*[f"`{k}`" for k in keys]).agg(F.min("_first").alias("_first"))
    return best.select(
        *[F.col(f"`{k}`") for k in keys],
        *[F.col("_first.row").getField(c).alias(c) for c in kept],
    ).select(*[F.col(f"`{c}`") for c in df.columns])


def newest_first(day: Column) -> Column:
    """Sort rank of a date, latest first and null last, for an ascending order."""
    return F.coalesce(-F.unix_date(day), F.lit(2147483647))
