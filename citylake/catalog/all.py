"""Imports every query module so that the registry is complete."""

from citylake.catalog import cleaning, features, io_queries, model_queries, payload_queries, products, rollups, streams  # noqa: F401
from citylake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
