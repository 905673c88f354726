"""Column expressions for path and pair text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_string(path: Column | str, sep: str = "->") -> Column:
    """``a->b->c`` from an ``array<long>`` path."""
    p = F.col(path) if isinstance(path, str) else path
    return F.array_join(F.transform(p, lambda x: x.cast("string")), sep)


def double_string(c: Column | str) -> Column:
    """Shortest round-trip text of a double, as Java's ``Double.toString`` prints
    the values of these jobs (e.g. ``0.0``, ``133.79999999999998``)."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")
