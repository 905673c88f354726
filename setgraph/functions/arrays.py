"""Array-to-rows helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, arr: Column | str, name: str, *keep: Column | str,
                 pos: str | None = None) -> DataFrame:
    """``keep..., [pos,] name``: one row per element of ``arr`` (like ``explode``).

    Written as ``explode_outer`` plus a not-null filter on the element: for
    arrays without NULL elements the rows are those of ``explode``, but
    Catalyst infers no ``size(arr) > 0`` filter.  That inferred filter would be
    pushed below a preceding repartition and evaluate an expensive array
    expression (the tokenizer) a second time, in the scan tasks.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    if pos is None:
        out = df.select(*keep, F.explode_outer(a).alias(name))
    else:
        out = df.select(*keep, F.posexplode_outer(a).alias(pos, name))
    return out.where(F.col(name).isNotNull())
