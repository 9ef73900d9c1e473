"""The registered queries and the SQL that they are checked against."""

from __future__ import annotations

from . import contracts, features, growing, labelling, metrics, models, reports  # noqa: F401
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
