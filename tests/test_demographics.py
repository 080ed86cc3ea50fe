import pytest
from pyspark.sql import functions as F

from kithwork.operators import demographics as dm
from kithwork.sources.lines import with_birth_date

COLUMNS = "uid bigint, street string, city string, state string, dob string"


def profiles(spark, *rows):
    return with_birth_date(spark.createDataFrame([(u, f"{u} Main", "Town", "TX", dob) for u, dob in rows], COLUMNS))


def test_age_units(spark):
    people = profiles(spark, (1, "8/15/1990"))
    assert dm.profile_age(people).first().age == 25.5
    assert dm.profile_age(people, unit="year").first().age == 26.0
    with pytest.raises(ValueError):
        dm.profile_age(people, unit="day")


def brute(edges, people, unit):
    ages = {}
    for u, dob in people:
        month, _, year = map(int, dob.split("/"))
        ages[u] = (2016 - year) * 12 + 2 - month if unit == "month" else (2016 - year) * 12
    sums = {}
    for u, f in edges:
        if f in ages:
            total, n = sums.get(u, (0, 0))
            sums[u] = (total + ages[f], n + 1)
    return {u: (t / (12 * n), n) for u, (t, n) in sums.items()}


@pytest.mark.parametrize("unit", ["month", "year"])
def test_average_and_top(spark, skewed, unit):
    """User 7 is in every list, which makes it a hot key of the join with the profiles."""
    edges = [(u, f) for u in range(60) for f in {7, (u * 3) % 60, (u * 5 + 1) % 60} if f != u]
    people = [(u, f"{u % 12 + 1}/3/{1950 + u % 40}") for u in range(60) if u % 9]
    frame = spark.createDataFrame(edges, "uid bigint, friend bigint")
    expected = brute(edges, people, unit)
    found = {r.uid: (r.avg_age, r.n) for r in dm.friend_age_avg(frame, profiles(spark, *people), unit=unit).collect()}
    assert found.keys() == expected.keys()
    for uid, (age, n) in expected.items():
        assert found[uid][1] == n and found[uid][0] == pytest.approx(age, abs=1e-12)
    own = {u for u, _ in people}
    order = sorted((u for u in expected if u in own), key=lambda u: (-found[u][0], u))[:20]
    top = dm.top_friend_age(frame, profiles(spark, *people), unit=unit).orderBy("rank").collect()
    assert [(r["rank"], r.uid) for r in top] == list(enumerate(order, 1))
    assert top[0].address == f"{order[0]} Main, Town, TX"


def test_users_without_known_ages_are_left_out(spark):
    edges = spark.createDataFrame([(1, 2), (3, 4), (5, 2)], "uid bigint, friend bigint")
    people = profiles(spark, (1, "2/1/1990"), (2, "2/1/1980"), (3, "2/1/1970"))
    averages = dm.friend_age_avg(edges, people)
    assert sorted(r.uid for r in averages.collect()) == [1, 5]
    assert [r.uid for r in dm.top_friend_age(edges, people).collect()] == [1]


def test_ranking_on_two_decimals_breaks_ties_by_id(spark):
    edges = [(1, f) for f in range(10, 13)] + [(2, f) for f in range(10, 16)]
    people = [(f, f"2/1/{1950 + (f == 12)}") for f in range(10, 16)] + [(1, "2/1/1990"), (2, "2/1/1990")]
    frame = spark.createDataFrame(edges, "uid bigint, friend bigint")
    exact = dm.top_friend_age(frame, profiles(spark, *people)).orderBy("rank").collect()
    assert [r.uid for r in exact] == [2, 1]
    rounded = dm.top_friend_age(frame, profiles(spark, *people), rank_on="rounded").orderBy("rank").collect()
    assert [r.avg_age for r in rounded] == [65.83, 65.67]
    averages = dm.friend_age_avg(frame, profiles(spark, *people)).agg(F.max("avg_age"), F.min("avg_age")).first()
    assert 65 <= averages[1] <= averages[0] <= 66
