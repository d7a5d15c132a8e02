"""Registered queries over the driver tables, each with its SQL equivalent where SQL can express it."""

from roadledger.catalog import (bi, drift, features, gate, ingest, ordering, scalars, star, streams,  # noqa: F401
                                training)
from roadledger.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
