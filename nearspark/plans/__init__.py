"""All registered queries; importing this package fills the registry."""

from . import documents, edits, sql, tables, vectors  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
