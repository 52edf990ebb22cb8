"""Registered queries over the given tables, each with its oracle SQL where SQL can say it."""

from workload import (
    audits,
    batches,
    documents,
    layers,
    marts,
    quality,
    scalars,
    search,
    sinks,
    sources,
)
from workload.base import REGISTRY, TABLES, Data

__all__ = [
    "REGISTRY",
    "TABLES",
    "Data",
    "audits",
    "batches",
    "documents",
    "layers",
    "marts",
    "quality",
    "scalars",
    "search",
    "sinks",
    "sources",
]
