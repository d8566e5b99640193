"""The report queries."""
