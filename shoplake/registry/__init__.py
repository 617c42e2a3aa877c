"""Registered queries and the SQL they are checked against."""

from shoplake.registry import batch, learning, serving, storage, streams, upkeep  # noqa: F401
from shoplake.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
