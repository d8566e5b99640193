"""Readers for logs, extracts, rosters and relational tables."""
