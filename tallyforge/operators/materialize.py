"""Intermediates that several sections of a report share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyforge.session import working_folder


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared working folder and read it back.

    The input is then scanned once however many sections use the result, the result outlives lost
    executors, and its real size guides every join with it.
    """
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
