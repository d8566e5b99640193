"""Incremental loading of event logs."""
