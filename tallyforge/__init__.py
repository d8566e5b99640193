"""Compute-usage accounting and quarterly reporting on Spark DataFrames."""

__version__ = "0.1.0"
