"""Common ids of long lists by bitmaps, and when mutual friends use them."""

import random

import pytest
from pyspark.sql import functions as F

from kithwork.operators import graph
from kithwork.operators.bitmaps import BUCKET_IDS, bitmaps, common_ids, ids_of
from kithwork.session import id_frame, settings

EDGE_IDS = [1, 2, BUCKET_IDS, BUCKET_IDS + 1, 2 * BUCKET_IDS, 5_000_000_000, 0, -1, -BUCKET_IDS, -BUCKET_IDS - 1, -7_000_000_000]


def lists(spark, content):
    return spark.createDataFrame([(u, f) for u, fs in content.items() for f in fs], "uid bigint, friend bigint").repartition(3)


def test_bitmaps_hold_all_ids(spark):
    r = random.Random(1)
    ids = sorted(set(EDGE_IDS) | {r.randrange(-200_000, 200_000) for _ in range(3000)})
    maps = bitmaps(lists(spark, {7: ids}), "uid", "friend")
    found = maps.select("uid", F.explode(ids_of(F.col("bucket"), F.col("bits"))).alias("friend")).collect()
    assert sorted(x.friend for x in found) == ids and {x.uid for x in found} == {7}


def test_common_ids_equal_set_intersection(spark):
    r = random.Random(2)
    content = {u: {r.randrange(-50_000, 90_000) for _ in range(n)} | set(EDGE_IDS[: u + 3]) for u, n in enumerate((4000, 5000, 10, 3000))}
    asked = [(0, 1), (1, 3), (2, 0), (0, 99)]
    pairs = spark.createDataFrame(asked, "u1 bigint, u2 bigint")
    found = {(x.u1, x.u2, x.friend) for x in common_ids(lists(spark, content), pairs).collect()}
    assert found == {(a, b, f) for a, b in asked for f in content[a] & content.get(b, set())}


@pytest.mark.parametrize("rows,used", [("50", True), ("100000", False)])
def test_only_dense_pairs_of_hubs_are_compared_by_bitmaps(spark, rows, used):
    """Lists of 60 and 70 of 100 ids are long here, the others short; a wide id would make all lists thin."""
    content = {1000: set(range(60)), 1001: set(range(30, 100)), 5: {1, 2, 40}}
    edges = lists(spark, content)
    with settings(spark, {graph.HUB_ROWS_SETTING: rows}):
        found = graph.mutual_friends(edges, id_frame(spark, u1=[1000, 1000, 5], u2=[1001, 5, 1001]))
        assert ("bitmap_and_agg" in found._jdf.queryExecution().optimizedPlan().toString()) == used
        got = {(x.u1, x.u2, x.friend) for x in found.collect()}
    assert got == {(a, b, f) for a, b in ((1000, 1001), (1000, 5), (5, 1001)) for f in content[a] & content[b]}
    thin = lists(spark, {**content, 6: {10**9}})
    with settings(spark, {graph.HUB_ROWS_SETTING: rows}):
        found = graph.mutual_friends(thin, id_frame(spark, u1=[1000], u2=[1001]))
        assert "bitmap_and_agg" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert {x.friend for x in found.collect()} == set(range(30, 60))
