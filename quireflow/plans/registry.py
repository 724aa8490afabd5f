"""All registered queries and their SQL."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
