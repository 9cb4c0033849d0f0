"""Incremental form of the jobs."""
