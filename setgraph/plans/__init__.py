"""Query registry and its SQL oracle."""

from .catalog import QUERIES
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
