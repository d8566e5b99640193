"""Reusable DataFrame operators that the report plans are composed from."""
