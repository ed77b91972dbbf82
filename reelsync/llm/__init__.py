"""Operators of a training-data pipeline; nothing else in the library imports them.

``QUERIES`` and ``ORACLE_SQL`` hold their registered queries.
"""

from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
