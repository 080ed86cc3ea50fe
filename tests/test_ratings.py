import random

import pytest
from pyspark.sql import functions as F

from kithwork.operators import ratings as rt


def movies(spark, *rows):
    return spark.createDataFrame(rows, "item_id bigint, title string, genres string")


def rated(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating int").repartition(3)


def people(spark, *rows):
    return spark.createDataFrame(rows, "user_id bigint, gender string, age int, zip string")


@pytest.mark.parametrize(
    "genres, plain, exact",
    [
        ("A|B|C", "1) A, 2) B & 3) C <t>", "1) A, 2) B & 3) C <t>"),
        ("A|B", "1) A & 2) B <t>", "1) A & 2) B <t>"),
        ("A", "1) A <t>", " 1) A <t>"),
        ("", "1)  <t>", " 1)  <t>"),
        ("||", "<t>", "t>"),
        (None, None, None),
    ],
)
def test_numbered_genres(spark, genres, plain, exact):
    df = movies(spark, (1, "T", genres))
    assert rt.format_genres(df, "<t>").first().genres_text == plain
    assert rt.format_genres(df, "<t>", exact=True).first().genres_text == exact


def test_select_users_is_strict_and_matches_the_whole_zip(spark):
    rows = [(1, "F", 21, "1"), (2, "F", 34, "199"), (3, "F", 20, "1"), (4, "F", 35, "1"), (5, "M", 30, "1"), (6, "F", 30, "21"), (7, "F", 30, "10\n2")]
    assert sorted(r.user_id for r in rt.select_users(people(spark, *rows)).collect()) == [1, 2]


def test_select_movies_needs_every_genre(spark):
    df = movies(spark, (1, "a", "Action|War"), (2, "b", "War"), (3, "c", "War|X|Action"), (4, "d", None))
    assert sorted(r.item_id for r in rt.select_movies(df).collect()) == [1, 3]


@pytest.fixture
def hot(spark, skewed):
    """Item 3 holds a third of the ratings, user 5 a third of the others; items 3 and 8 tie at the bottom."""
    rng = random.Random(4)
    rows = {(u, 3): 1 for u in range(120)}
    rows |= {(5, i): 1 + i % 5 for i in range(10, 130)}
    rows |= {(rng.randrange(100), rng.randrange(10, 60)): 3 for _ in range(150)}
    rows |= {(u, 8): 1 for u in (5, 7, 13)}
    return [(u, i, r) for (u, i), r in rows.items()]


def test_lowest_rated_and_who_rated_them(spark, hot):
    known = movies(spark, *((i, f"m{i}", "Action|War" if i != 9 else "War") for i in range(130)))
    df, chosen = rated(spark, hot), rt.select_movies(known)
    averages = {r.item_id: r.avg_rating for r in rt.movie_avg_rating(df, chosen).collect()}
    sums = {}
    for _, i, r in hot:
        sums.setdefault(i, []).append(r)
    assert averages == {i: sum(v) / len(v) for i, v in sums.items()}
    low = min(averages.values())
    lowest = {i for i, a in averages.items() if a == low}
    assert {3, 8} <= lowest
    assert {r.item_id for r in rt.lowest_rated_movies(df, chosen).collect()} == lowest
    assert [r.item_id for r in rt.lowest_rated_movies(df, chosen, ties=False).collect()] == [min(lowest)]
    users = people(spark, *((u, "F" if u % 2 else "M", 20 + u % 20, f"{u % 3}9") for u in range(120)))
    asked = {r.user_id for r in rt.select_users(users).collect()}
    expected = sorted(u for u, i, _ in hot if i in lowest and u in asked)
    assert len(expected) > len(set(expected))
    assert sorted(r.user_id for r in rt.raters_of_lowest(df, chosen, rt.select_users(users)).collect()) == expected
    found = rt.raters_of_lowest(df, chosen, rt.select_users(users), distinct=True).collect()
    assert sorted(r.user_id for r in found) == sorted(set(expected))


def test_cogroup_in_parts_holds_every_row(spark, hot):
    known = movies(spark, *[(i, f"m{i}", "G") for i in range(0, 200, 2)], (3, "m3", "G"), (3, "again", "G"))
    groups = {}
    rows = rt.movie_rating_cogroup(rated(spark, hot), known).collect()
    for r in rows:
        assert len(r.ratings) < 60
        ratings, titles = groups.setdefault(r.item_id, ([], []))
        assert r.ratings and r.movies
        ratings += [(x.user_id, x.rating, m.title) for x in r.ratings for m in r.movies]
        titles += [m.title for m in r.movies]
    assert len([r for r in rows if r.item_id == 3]) > 1
    ids = {i for _, i, _ in hot} & ({*range(0, 200, 2), 3})
    assert groups.keys() == ids
    for i in ids:
        known_as = ["again", "m3"] if i == 3 else [f"m{i}"]
        assert sorted(groups[i][0]) == sorted((u, r, m) for u, j, r in hot if j == i for m in known_as)
        assert sorted(set(groups[i][1])) == known_as


def test_cogroup_limit_takes_the_first_ids(spark):
    df = rated(spark, [(1, i, 3) for i in (9, 2, 5)])
    known = movies(spark, *((i, "t", "g") for i in (2, 5, 7, 9)))
    found = rt.movie_rating_cogroup(df, known, limit=2).collect()
    assert sorted((r.item_id, r.part) for r in found) == [(2, 0), (5, 0)]


def test_rating_stats(spark, hot):
    row = rt.rating_stats(rated(spark, hot + hot[:7])).first()
    assert tuple(row) == (len({u for u, _, _ in hot}), len({i for _, i, _ in hot}), len(hot) + 7)
    empty = rt.rating_stats(rated(spark, hot).where(F.lit(False))).first()
    assert tuple(empty) == (0, 0, 0)
