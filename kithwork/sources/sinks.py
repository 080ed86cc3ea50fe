"""Text output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def as_lines(df: DataFrame, sep: str = "\t", style: str = "plain") -> DataFrame:
    """One ``value`` per row: the columns joined by ``sep``, nulls as empty text.

    ``style='tuple'`` writes ``(a,b)``, the form of a saved collection of pairs.
    """
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    if style == "tuple":
        return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("value"))
    if style == "plain":
        return df.select(F.concat_ws(sep, *fields).alias("value"))
    raise ValueError(f"style must be 'plain' or 'tuple', not {style!r}")


def write_text(
    df: DataFrame, path: str, mode: str = "overwrite", sep: str = "\t", style: str = "plain"
) -> None:
    """Write one text line per row. ``mode``: ``overwrite`` or ``errorifexists``."""
    as_lines(df, sep, style).write.mode(mode).text(path)
