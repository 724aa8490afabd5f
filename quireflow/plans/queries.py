"""All registered queries: importing the modules registers them."""

from . import documents, rows, texts
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "documents", "rows", "texts"]
