"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kithwork.functions import split_fields


def word_count(lines: DataFrame) -> DataFrame:
    """``(word, n)``: words are split at single spaces only, case and punctuation stay.

    Counts are combined in every task before the shuffle, so a very frequent word costs one row
    per task.
    """
    words = lines.select(F.explode(split_fields(F.col("value"), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
