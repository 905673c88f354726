"""Operators of a training-data pipeline on Spark DataFrames.

Each module holds one operator with its own general interface; ``catalog``
registers one query per operator over the shared tables and ``oracle`` holds
SQL for those that SQL can express.  Nothing else in the library imports this
subpackage.
"""

from .catalog import QUERIES
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
