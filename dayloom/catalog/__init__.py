"""Importing the package registers every query."""

from dayloom.catalog import (  # noqa: F401
    build,
    cleaning,
    feeds,
    modelling,
    parsing,
    quality,
    series,
    streams,
    updates,
)
from dayloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
