"""The registered queries: each operator over the given tables, with its SQL twin."""

from lumenloom.queries import (
    billing,
    catalogue,
    images,
    messaging,
    observability,
    scalars,
    selection,
    streams,
    versions,
)
from lumenloom.queries.registry import ORACLES as ALL_ORACLES
from lumenloom.queries.registry import QUERIES as ALL_QUERIES

__all__ = [
    "ALL_ORACLES",
    "ALL_QUERIES",
    "billing",
    "catalogue",
    "images",
    "messaging",
    "observability",
    "scalars",
    "selection",
    "streams",
    "versions",
]
