"""Graph operators against brute force, on an ordinary graph and on one with a hub."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kithwork.operators import graph
from kithwork.operators.skew import measure
from kithwork.session import id_frame


def neighbours(users, extra, seed, hub=None):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(users), 2))) for _ in range(extra)}
    if hub is not None:
        pairs |= {tuple(sorted((hub, other))) for other in range(users) if other != hub}
    friends = {}
    for a, b in pairs:
        friends.setdefault(a, set()).add(b)
        friends.setdefault(b, set()).add(a)
    return friends


def frame(spark, friends):
    rows = [(u, f) for u, fs in friends.items() for f in fs]
    return spark.createDataFrame(rows, "uid bigint, friend bigint").repartition(4)


@pytest.fixture(params=["plain", "hub"])
def case(request, spark):
    if request.param == "plain":
        friends = neighbours(40, 120, 1)
        yield spark, friends, frame(spark, friends)
    else:
        request.getfixturevalue("skewed")
        friends = neighbours(60, 60, 2, hub=7)
        edges = frame(spark, friends)
        assert 7 in measure(edges, "uid")[0].splits(10)
        yield spark, friends, edges


def brute_candidates(friends, targets):
    counts = {}
    for target in targets:
        for via in friends.get(target, ()):
            for candidate in friends[via]:
                if candidate != target and candidate not in friends[target]:
                    counts[target, candidate] = counts.get((target, candidate), 0) + 1
    return counts


def test_mutual_friends_of_all_pairs(case):
    spark, friends, edges = case
    pairs = [(a, b) for a, b in combinations(sorted(friends), 2)] + [(3, 999)]
    asked = spark.createDataFrame(pairs + pairs[:5], "u1 bigint, u2 bigint")
    expected = {(a, b, f) for a, b in pairs for f in friends.get(a, set()) & friends.get(b, set())}
    found = [tuple(r) for r in graph.mutual_friends(edges, asked).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    swapped = asked.select(F.col("u2").alias("u1"), F.col("u1").alias("u2"))
    assert {(b, a, f) for a, b, f in map(tuple, graph.mutual_friends(edges, swapped).collect())} == expected


def test_mutual_friends_list_has_every_pair(case):
    spark, friends, edges = case
    pairs = [(a, b) for a, b in combinations(sorted(friends)[:12], 2)] + [(3, 999)]
    asked = spark.createDataFrame(pairs, "u1 bigint, u2 bigint")
    found = {}
    for r in graph.mutual_friends_list(edges, asked).collect():
        found.setdefault((r.u1, r.u2), []).extend(r.friends.split(",") if r.friends else [])
    assert set(found) == set(pairs)
    for a, b in pairs:
        assert sorted(map(int, found[a, b])) == sorted(friends.get(a, set()) & friends.get(b, set()))


def test_common_friends_counts_lists(case):
    spark, friends, edges = case
    ids = [1, 5, 7, 9]
    found = dict(graph.common_friends(edges, id_frame(spark, uid=ids + [5])).collect())
    counts = {}
    for uid in ids:
        for friend in friends.get(uid, ()):
            counts[friend] = counts.get(friend, 0) + 1
    assert found == {f: n for f, n in counts.items() if n >= 2}


def test_candidates_and_recommendations(case):
    spark, friends, edges = case
    targets = [1, 5, 7, 33, 999]
    asked = id_frame(spark, target=targets)
    expected = brute_candidates(friends, targets)
    found = {(r.target, r.candidate): r.n for r in graph.friend_candidates(edges, asked).collect()}
    assert found == expected
    best = {}
    for r in graph.recommend_friends(edges, asked, k=4).orderBy("target", "rank").collect():
        best.setdefault(r.target, []).append((r.candidate, r.n))
    for target in targets:
        ranked = sorted(((c, n) for (t, c), n in expected.items() if t == target), key=lambda x: (-x[1], x[0]))
        assert best.get(target, []) == ranked[:4]
    lists = {r.target: r.candidates for r in graph.recommendation_list(edges, asked, k=4).collect()}
    assert lists == {t: ",".join(str(c) for c, _ in best.get(t, [])) for t in targets if t in friends}
    everyone = {}
    for r in graph.candidate_list(edges, asked).collect():
        everyone.setdefault(r.target, set()).update(map(int, r.candidates.split(",")) if r.candidates else [])
    assert everyone == {t: {c for (u, c) in expected if u == t} for t in targets if t in friends}


def test_adjacency_lists_are_whole_and_bounded(case):
    spark, friends, edges = case
    rows = graph.edges_adjacency(edges).collect()
    found = {}
    for r in rows:
        assert list(r.friends) == sorted(r.friends)
        found.setdefault(r.uid, []).extend(r.friends)
    assert {u: sorted(fs) for u, fs in found.items()} == {u: sorted(fs) for u, fs in friends.items()}
    if max(map(len, friends.values())) > 50:
        hub = [len(r.friends) for r in rows if r.uid == 7]
        assert len(hub) > 1 and max(hub) < 40
        assert all(r.part == 0 for r in rows if len(friends[r.uid]) <= 10)


def test_adjacency_lists_when_sizes_are_counted(spark, skewed, monkeypatch):
    """The way taken when the table is too large for the sketch to list every long bag."""
    from kithwork.operators import skew

    monkeypatch.setattr(skew, "MAX_HOT", 4)
    friends = neighbours(60, 60, 2, hub=7)
    found = {}
    for r in graph.edges_adjacency(frame(spark, friends)).collect():
        assert len(r.friends) < 40
        found.setdefault(r.uid, []).extend(r.friends)
    assert {u: sorted(fs) for u, fs in found.items()} == {u: sorted(fs) for u, fs in friends.items()}


def test_one_list_step(spark):
    edges = spark.createDataFrame([(5, 2), (5, 3), (5, 4)], "uid bigint, friend bigint")
    found = graph.friend_candidates(edges, id_frame(spark, target=[2])).collect()
    assert sorted(map(tuple, found)) == [(2, 3, 1), (2, 4, 1)]


def test_profiles_of_mutual_friends(case):
    spark, friends, edges = case
    people = [(u, f"N{u}", "L", f"{u:05d}") for u in friends if u % 3]
    profiles = spark.createDataFrame(people, "uid bigint, first_name string, last_name string, zip string")
    pairs = list(combinations(sorted(friends)[:10], 2))
    asked = spark.createDataFrame(pairs, "u1 bigint, u2 bigint")
    expected = {(a, b, f) for a, b in pairs for f in friends[a] & friends[b] if f % 3}
    rows = graph.mutual_friend_profiles(edges, profiles, asked).collect()
    assert {(r.u1, r.u2, r.friend) for r in rows} == expected and len(rows) == len(expected)
    assert all(r.name == f"N{r.friend} L" and r.zip == f"{r.friend:05d}" for r in rows)
    texts = {}
    for r in graph.mutual_friend_profiles_list(edges, profiles, asked).collect():
        texts.setdefault((r.u1, r.u2), []).extend(r.profiles.split(","))
    assert {p: sorted(t) for p, t in texts.items()} == {
        (a, b): sorted(f"N{f} L:{f:05d}" for (c, d, f) in expected if (c, d) == (a, b)) for a, b, _ in expected
    }


def test_simple_edges(spark):
    raw = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1)], "uid bigint, friend bigint")
    assert sorted(map(tuple, graph.simple_edges(raw).collect())) == [(1, 2), (2, 1)]


@pytest.mark.parametrize("partitions", [1, 4, 16, 64])
def test_parts_are_runs_of_the_sorted_list_whatever_the_partitioning(spark, skewed, partitions):
    rows = [(1, i * 7 % 101) for i in range(101)] + [(2, i) for i in range(15)] + [(3, i) for i in range(16)]
    df = spark.createDataFrame(rows, "uid bigint, friend bigint").repartition(partitions)
    found = {(r.uid, r.part): list(r.friends) for r in graph.edges_adjacency(df).collect()}
    want = {}
    for uid, n in ((1, 101), (2, 15), (3, 16)):
        want |= {(uid, at // 15): list(range(at, min(at + 15, n))) for at in range(0, n, 15)}
    assert found == want
