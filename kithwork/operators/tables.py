"""Small relational helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns.

    Every task keeps its own first row per key before the shuffle.
    """
    rest = [name for name in df.columns if name != key and name not in order]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("first"))
    return first.select(key, "first.*").select(*df.columns)
