"""Inputs for checking the library: views over the given tables, and SQL twins of each query."""
