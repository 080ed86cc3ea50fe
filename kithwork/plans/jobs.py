"""Whole jobs from input files to an output folder, one per question."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kithwork import sources
from kithwork.operators import classify, clustering, demographics, factorize, graph, ratings, tree, words
from kithwork.operators.tables import keep_first
from kithwork.session import cut_lineage, id_frame


LOG = logging.getLogger("kithwork.jobs")


def _stored(spark: SparkSession, path: str, read: Callable[[Observation], DataFrame]) -> DataFrame:
    """An input parsed and stored in one scan, which also counts the lines that lost a value; every step reads it."""
    rejects = Observation()
    rows = cut_lineage(read(rejects))
    n = rejects.get[sources.REJECTED]
    if n:
        LOG.warning("%d lines of %s could not be read in full", n, path)
    return rows


def _key(key: Column) -> Column:
    """The key of an output line; the later lines of a list in parts carry the part: ``key#1``, ``key#2``, ..."""
    return F.concat(key, F.when(F.col("part") > 0, F.concat(F.lit("#"), F.col("part").cast("string"))).otherwise(""))


def _edges(spark: SparkSession, adjacency: str) -> DataFrame:
    """The friend graph of a file of lists, cleaned."""
    lines = sources.read_lines(spark, adjacency)
    return _stored(spark, adjacency, lambda rejects: graph.simple_edges(sources.adjacency_edges(lines, rejects)))


def _profiles(spark: SparkSession, profiles: str) -> DataFrame:
    lines = sources.read_lines(spark, profiles)
    return _stored(spark, profiles, lambda rejects: keep_first(sources.parse_profiles(lines, rejects), "uid"))


def _labeled(spark: SparkSession, labeled: str) -> DataFrame:
    lines = sources.read_lines(spark, labeled)
    return _stored(spark, labeled, lambda rejects: sources.parse_labeled(lines, rejects))


def _table(spark: SparkSession, path: str, layout: str, sep: str) -> DataFrame:
    return _stored(spark, path, lambda rejects: sources.read_table(spark, path, layout, sep, rejects))


def word_count(spark: SparkSession, source: str, out: str, mode: str = "errorifexists", style: str = "plain") -> None:
    """``word<TAB>count`` lines; the output folder must not exist unless ``mode`` says otherwise."""
    sources.write_text(words.word_count(sources.read_lines(spark, source)), out, mode, style=style)


def mutual_friend(spark: SparkSession, adjacency: str, out: str, u1: int, u2: int) -> None:
    """``u1,u2<TAB>f1,f2,...``, also without any mutual friend; one line, see ``_key`` for very long lists."""
    found = graph.mutual_friends_list(_edges(spark, adjacency), id_frame(spark, u1=[u1], u2=[u2]))
    sources.write_text(found.select(_key(F.concat_ws(",", "u1", "u2")).alias("pair"), "friends"), out)


def common_friend(spark: SparkSession, adjacency: str, out: str, uids: list[int]) -> None:
    """``friend<TAB>lists``: the friends that at least two of the given users have."""
    sources.write_text(graph.common_friends(_edges(spark, adjacency), id_frame(spark, uid=uids)), out)


def mutual_friend_zip(spark: SparkSession, adjacency: str, profiles: str, out: str, u1: int, u2: int) -> None:
    """``u1,u2<TAB>name:zip,...``; nothing where no mutual friend has a profile."""
    pair = id_frame(spark, u1=[u1], u2=[u2])
    found = graph.mutual_friend_profiles_list(_edges(spark, adjacency), _profiles(spark, profiles), pair)
    sources.write_text(found.select(_key(F.concat_ws(",", "u1", "u2")).alias("pair"), "profiles"), out)


def recommend_friend(spark: SparkSession, adjacency: str, out: str, targets: list[int], k: int | None = 10) -> None:
    """``target<TAB>c1,c2,...``, best first; ``k=None`` lists every candidate in id order."""
    edges, asked = _edges(spark, adjacency), id_frame(spark, target=targets)
    if k is None:
        found = graph.candidate_list(edges, asked).select(_key(F.col("target").cast("string")).alias("target"), "candidates")
    else:
        found = graph.recommendation_list(edges, asked, k)
    sources.write_text(found, out)


def top_average_age(
    spark: SparkSession,
    adjacency: str,
    profiles: str,
    out: str,
    unit: str = "month",
    rank_on: str = "exact",
    as_of: tuple[int, int] = demographics.AS_OF,
    n: int = demographics.TOP_USERS,
) -> None:
    """``uid<TAB>street, city, state, age`` of the users with the oldest friends, oldest first."""
    people = _profiles(spark, profiles)
    top = demographics.top_friend_age(_edges(spark, adjacency), people, as_of, unit, n, rank_on)
    # The report has n rows, so one file in rank order.
    report = demographics.report_lines(top, rank_on == "rounded").orderBy("rank").select("uid", "text")
    sources.write_text(report.coalesce(1), out)


def lowest_rated(
    spark: SparkSession, movies: str, rated: str, users: str, sep: str = ":", distinct: bool = False
) -> DataFrame:
    """Who, of the selected users, rated a lowest-rated movie of the selected ones."""
    known, given, people = (_table(spark, *table, sep) for table in ((movies, "movies"), (rated, "ratings"), (users, "users")))
    return ratings.raters_of_lowest(given, ratings.select_movies(known), ratings.select_users(people), distinct)


def movies_with_ratings(spark: SparkSession, movies: str, rated: str, sep: str = ":", limit: int | None = 5) -> DataFrame:
    known, given = _table(spark, movies, "movies", sep), _table(spark, rated, "ratings", sep)
    return ratings.movie_rating_cogroup(given, known, limit)


def numbered_genres(spark: SparkSession, movies: str, tag: str, sep: str = ":") -> DataFrame:
    return ratings.format_genres(_table(spark, movies, "movies", sep), tag)


def cluster_movies(spark: SparkSession, movies: str, rated: str, sep: str = "::") -> DataFrame:
    """Sample movies of every cluster."""
    known, given = _table(spark, movies, "movies", sep), _table(spark, rated, "ratings", sep)
    return clustering.cluster_samples(clustering.kmeans_items(given), known)


def classify_file(spark: SparkSession, labeled: str, method: str = "decision_tree") -> DataFrame:
    """Accuracy on the test part of a file of labelled rows."""
    rows = _labeled(spark, labeled)
    return classify.accuracy({"decision_tree": classify.decision_tree, "naive_bayes": classify.naive_bayes}[method](rows))


def cluster_listing(spark: SparkSession, movies: str, rated: str, sep: str = "::") -> DataFrame:
    """The samples of every cluster as ``id,title,genres``."""
    return clustering.sample_lines(cluster_movies(spark, movies, rated, sep))


def tree_text(spark: SparkSession, labeled: str) -> DataFrame:
    """``(n, line)``: the decision tree fitted on the training part of a file of labelled rows, as text."""
    train, _ = classify.split_by_id(_labeled(spark, labeled))
    return tree.tree_text(tree.fit_tree(train))


def predict_ratings(
    spark: SparkSession, rated: str, user_ids: list[int], item_ids: list[int], sep: str = "::", **options
) -> DataFrame:
    """Predicted ratings of the pairs (user_ids[i], item_ids[i])."""
    users, items = factorize.als_factors(_table(spark, rated, "ratings", sep), **options)
    return factorize.als_predict(id_frame(spark, user_id=user_ids, item_id=item_ids), users, items)
