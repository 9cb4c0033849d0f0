"""Monitoring of published documents as Spark jobs."""

from docmonitor.params import RunParams

__all__ = ["RunParams"]
