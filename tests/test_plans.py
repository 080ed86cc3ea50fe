"""What the physical plans must and must not contain, on the given tables."""

import os

import pytest
from pyspark.sql import functions as F

from kithwork.operators import demographics, graph, ratings, words
from kithwork.session import id_frame
from registry.views import stored, view

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_before_the_shuffle(spark):
    text = plan(words.word_count(view(spark, SF, "lines")))
    # The other exchange spreads the one split of the small table.
    assert text.count("ENSURE_REQUIREMENTS") == 1 and "partial_count" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_report_keeps_its_rows_without_a_full_sort(spark):
    text = plan(demographics.top_friend_age(stored(spark, SF, "edges"), view(spark, SF, "profiles")))
    assert "TakeOrderedAndProject(limit=20" in text and "rangepartitioning" not in text


def test_recommendations_are_cut_before_the_shuffle(spark):
    text = plan(graph.recommend_friends(stored(spark, SF, "edges"), id_frame(spark, target=[1, 5])))
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert [line.rsplit(",", 1)[1].strip() for line in limits] == ["Final", "Partial"]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_operator_but_the_library_vectors_needs_python_or_a_cross_join(spark):
    edges, rated = stored(spark, SF, "edges"), stored(spark, SF, "ratings")
    movies, users = view(spark, SF, "movies"), view(spark, SF, "users")
    pairs = id_frame(spark, u1=[33], u2=[1])
    frames = [
        graph.mutual_friends(edges, pairs),
        graph.edges_adjacency(edges),
        ratings.movie_rating_cogroup(rated, movies),
        ratings.raters_of_lowest(rated, ratings.select_movies(movies), ratings.select_users(users)),
        ratings.rating_stats(rated),
        ratings.format_genres(movies),
    ]
    for df in frames:
        text = plan(df)
        for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
            assert word not in text


def test_broadcast_only_below_the_size_limit(large):
    edges, rated = stored(large, SF, "edges"), stored(large, SF, "ratings")
    movies, users = view(large, SF, "movies"), view(large, SF, "users")
    frames = [
        graph.friend_candidates(edges, id_frame(large, target=[1, 5])),
        graph.mutual_friends(edges, id_frame(large, u1=[33], u2=[1])),
        demographics.friend_age_avg(edges, stored(large, SF, "profiles")),
        ratings.raters_of_lowest(rated, ratings.select_movies(movies), ratings.select_users(users)),
    ]
    for df in frames:
        assert "Broadcast" not in plan(df) and "SortMergeJoin" in plan(df)


def test_one_pair_and_few_targets_never_shuffle_the_graph(spark):
    """Only the small counted sides are broadcast; the edges are scanned where they are."""
    spark.conf.set("kithwork.broadcast.maxRows", "500")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        edges = stored(spark, SF, "edges")
        assert edges.count() > 500
        text = plan(graph.mutual_friends(edges, id_frame(spark, u1=[33], u2=[1])))
        assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
        text = plan(graph.friend_candidates(edges, id_frame(spark, target=[1, 5])))
        assert "Exchange hashpartitioning(via" not in text
    finally:
        spark.conf.unset("kithwork.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    rated = stored(spark, SF, "ratings")
    text = plan(ratings.movie_avg_rating(rated.where(F.col("item_id") > 5), view(spark, SF, "movies")))
    assert "PushedFilters: [IsNotNull(item_id), GreaterThan(item_id,5)]" in text
    assert "ReadSchema: struct<item_id:bigint,rating:int>" in text


def test_cogroup_shuffles_each_side_once(large):
    text = plan(ratings.movie_rating_cogroup(stored(large, SF, "ratings"), view(large, SF, "movies")))
    assert text.count("Exchange hashpartitioning") == 2
