"""All registered queries."""

from tidemark.registry import changes, clinical, feeds, filters, jobs, joins, logtables, metadata, reshaping, scalars, scans, series, streams, targets  # noqa: F401
from tidemark.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
