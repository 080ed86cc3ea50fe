"""Delimited tables with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from .lines import NEEDED, _complete, count_rejects

# Fixed column layouts of the movie-rating tables.
MOVIES = "item_id bigint, title string, genres string"
RATINGS = "user_id bigint, item_id bigint, rating int, rated_at string"
USERS = "user_id bigint, gender string, age int, occupation int, zip string"


def read_table(spark: SparkSession, path: str, layout: str, sep: str = "::", rejects: Observation | None = None) -> DataFrame:
    """The rows of a table of movies, ratings or users that have the columns its layout needs."""
    schema = {"movies": MOVIES, "ratings": RATINGS, "users": USERS}[layout]
    whole = _complete(NEEDED[layout])
    return count_rejects(read_delimited(spark, path, schema, sep), ~whole, rejects).where(whole)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "::") -> DataFrame:
    """Scan a table without header or quoting; short rows and bad numbers give nulls.

    The column types are declared, so only the columns a query asks for are converted.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("quote", "")
        .option("escape", "")
        .csv(path)
    )
