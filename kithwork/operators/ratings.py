"""Relational queries over movies (item_id, title, genres), ratings (user_id, item_id, rating) and
users (user_id, gender, age, occupation, zip)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kithwork.functions import number_list, split_fields
from kithwork.session import cut_lineage

from .skew import bags, bags_in_parts, measure, spread_join

# Fixed values of the original question: who rated the worst of which movies.
GENRES = ("Action", "War")
GENDER = "F"
AGES = (20, 35)
ZIP_PATTERN = "1.*"

# 2^14 registers of a sketch, a few kilobytes.
SKETCH_BITS = 14


def select_users(
    users: DataFrame, gender: str = GENDER, ages: tuple[int, int] = AGES, zip_pattern: str = ZIP_PATTERN
) -> DataFrame:
    """Users of one gender, strictly between two ages, whose whole zip matches a pattern."""
    low, high = ages
    return users.where(
        (F.col("gender") == gender)
        & (F.col("age") > low)
        & (F.col("age") < high)
        & F.col("zip").rlike(f"^(?:{zip_pattern})$")
    )


def select_movies(movies: DataFrame, genres: tuple[str, ...] = GENRES) -> DataFrame:
    """Movies whose genre text contains every given name."""
    return movies.where(reduce(lambda a, b: a & b, (F.contains("genres", F.lit(g)) for g in genres)))


def movie_avg_rating(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``(item_id, avg_rating)`` of the rated ones among ``movies``.

    Ratings are summed per movie before the join, so that a movie with very many of them reaches
    the join as one row.
    """
    sums = ratings.groupBy("item_id").agg(F.sum("rating").alias("total"), F.count("rating").alias("n"))
    kept = sums.join(movies.select("item_id").distinct(), "item_id", "left_semi")
    return kept.select("item_id", (F.col("total") / F.col("n")).alias("avg_rating"))


def lowest_rated_movies(ratings: DataFrame, movies: DataFrame, ties: bool = True) -> DataFrame:
    """``(item_id, avg_rating)`` of the movies at the lowest average, or of one of them (lowest id)."""
    averages = movie_avg_rating(ratings, movies)
    if not ties:
        return averages.orderBy("avg_rating", "item_id").limit(1)
    # Whole-number ratings: equal averages are equal doubles.
    return averages.where(F.col("avg_rating") == averages.agg(F.min("avg_rating")).scalar())


def raters_of_lowest(
    ratings: DataFrame, movies: DataFrame, users: DataFrame, distinct: bool = False
) -> DataFrame:
    """``(user_id)``: the selected users who rated a lowest-rated movie, once per such rating.

    ``movies`` and ``users`` come already selected, see ``select_movies`` and ``select_users``.
    """
    lowest = cut_lineage(lowest_rated_movies(ratings, movies).select("item_id"))
    rated = ratings.select("user_id", "item_id")
    hot_item, hot_user = measure(rated, "item_id", "user_id")
    hot_lowest = measure(lowest, "item_id")[0]
    rated = spread_join(rated, lowest, "item_id", left_hot=hot_item, right_hot=hot_lowest)
    found = spread_join(rated, users.select("user_id").distinct(), "user_id", "left_semi", left_hot=hot_user)
    found = found.select("user_id")
    return found.distinct() if distinct else found


def movie_rating_cogroup(ratings: DataFrame, movies: DataFrame, limit: int | None = None) -> DataFrame:
    """``(item_id, part, ratings, movies)``: all rating rows and all movie rows of every id in both.

    The bags of a very large group come in several parts: every run of its ratings with every run of its
    movies, so both bags of a row are never empty and every pair of rows is in exactly one part. With
    ``limit`` the first ids in id order are chosen before any bag is built.
    """
    rating_item = F.struct(*[c for c in ratings.columns if c != "item_id"])
    movie_item = F.struct(*[c for c in movies.columns if c != "item_id"])
    if limit is not None:
        rated = ratings.select("item_id").distinct()
        first = movies.select("item_id").distinct().join(rated, "item_id", "left_semi").orderBy("item_id").limit(limit)
        first = F.broadcast(first)  # never more than ``limit`` rows
        ratings, movies = (df.join(first, "item_id", "left_semi") for df in (ratings, movies))
    left = bags(ratings, ["item_id"], rating_item, "ratings")
    right, whole = bags_in_parts(movies, ["item_id"], movie_item, "movies")
    if whole:
        return left.join(right.drop("part"), "item_id").select("item_id", "part", "ratings", "movies")
    right = right.withColumnRenamed("part", "_movie_part")
    runs = right.groupBy("item_id").agg((F.max("_movie_part") + 1).alias("_runs"))
    part = (F.col("part") * F.col("_runs") + F.col("_movie_part")).cast("int")
    return left.join(right.join(runs, "item_id"), "item_id").select("item_id", part.alias("part"), "ratings", "movies")


def format_genres(movies: DataFrame, tag: str = "", exact: bool = False) -> DataFrame:
    """``(title, genres_text)``: the bar-separated genres as a numbered list."""
    text = number_list(split_fields(F.col("genres"), "|"), tag, exact)
    return movies.select("title", text.alias("genres_text"))


def rating_stats(ratings: DataFrame) -> DataFrame:
    """``(users, items, n)``: distinct users, distinct items and rows, in one row.

    One scan: each row counts for its user and for its item, both are combined in every task, and what is
    shuffled is a row per user and one per item of a task.
    """
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("user_id").cast("bigint").alias("id")), F.struct(F.lit(1).alias("side"), F.col("item_id").cast("bigint").alias("id")))
    each = ratings.select(F.inline(sides)).groupBy("side", "id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    return each.agg(
        F.count_if((F.col("side") == 0) & known).alias("users"),
        F.count_if((F.col("side") == 1) & known).alias("items"),
        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)).alias("n"),
    )


def rating_sketches(ratings: DataFrame, *groups: str) -> DataFrame:
    """``(groups.., users, items, n)`` with HyperLogLog sketches of the users and items of every group.

    Sketches of any groups, days or tables can be merged (``merged_stats``), so new ratings need no old ones.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("bigint"), F.lit(SKETCH_BITS)).alias(name) for c, name in (("user_id", "users"), ("item_id", "items"))]
    return ratings.groupBy(*groups).agg(*sketches, F.count(F.lit(1)).alias("n"))


def merged_stats(sketches: DataFrame) -> DataFrame:
    """``(users, items, n)`` of all groups of ``rating_sketches`` together: the distinct counts are estimates with a
    standard error of 1.04 / sqrt(2^SKETCH_BITS), 0.8 %."""
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in ("users", "items")]
    return sketches.agg(*estimates, F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
