"""Factors in blocks and in stored buckets: what is shuffled, what is read."""

import random

import pytest
from pyspark.sql import functions as F

from kithwork.operators import clustering as cl, factorize as fz, ratings as rt, skew
from kithwork.session import cut_lineage, settings


@pytest.fixture
def rated(spark):
    r = random.Random(5)
    rows = list({(r.randrange(1, 60), r.randrange(1, 40)): None for _ in range(500)})
    return spark.createDataFrame([(u, i, 1 + (u * i) % 5) for u, i in rows], "user_id bigint, item_id bigint, rating int").repartition(3)


def executed(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_sums_stay_in_their_block(spark, rated):
    rows = rated.withColumn("rating", F.col("rating").cast("double"))
    blocks = fz.in_blocks(rows, "item_id", "user_id", {}, fz._block_numbers(spark, 4))
    users = cut_lineage(fz.start_factors(rated.select("user_id").distinct(), "user_id", 5))
    with settings(spark, fz.BY_BLOCK):
        text = executed(fz.solve(fz.normal_sums(blocks, users, 5), "item_id", 5, 1.0))
    above = text[: text.index("SortMergeJoin [block")]
    assert "Exchange" not in above and "partial_sum" in above
    # Every block has its own task.
    tasks = blocks.ratings.select("block", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == len({t.block for t in tasks}) == len({t.task for t in tasks}) == 4
    blocks.ratings.unpersist()
    blocks.routes.unpersist()


def test_a_half_round_shuffles_nothing_between_stored_factors_and_sums(spark, rated):
    rows = rated.withColumn("rating", F.col("rating").cast("double"))
    numbers = fz._block_numbers(spark, 4)
    blocks = fz.in_blocks(rows, "item_id", "user_id", {}, numbers)
    with settings(spark, fz.BY_BLOCK):
        users = fz._store(fz.start_factors(blocks.routes, "user_id", 2), "user_id", numbers)
        sums = fz.normal_sums(blocks, users, 2)
        assert "ENSURE_REQUIREMENTS" not in executed(sums)
        # Stored factors are known to be sorted, also those that a half-round made.
        items = fz._store(fz.solve(sums, "item_id", 2, 1.0), "item_id", numbers)
        assert "item_id" in items._jdf.queryExecution().executedPlan().outputOrdering().toString()
        found = {r.item_id: r for r in sums.collect()}
        assert 1 < sums.select(F.spark_partition_id()).distinct().count() <= 4
    blocks.unpersist()
    f = {r.user_id: (r.f0, r.f1) for r in users.collect()}
    for item, r in found.items():
        given = [(f[u], x) for u, i, x in rated.collect() if i == item]
        assert r.a_0_1 == pytest.approx(sum(a * b for (a, b), _ in given)) and r.b_1 == pytest.approx(sum(x * b for (_, b), x in given))


def test_stored_factors_are_read_by_bucket(spark, rated, tmp_path):
    users, items = fz.als_factors(rated, rounds=2)
    store = fz.save_factors(users, str(tmp_path / "u"), 8)
    assert fz.save_factors(users, str(tmp_path / "u"), 8) == store == (str(tmp_path / "u"), "user_id", 8)
    fz.save_factors(items, str(tmp_path / "i"), 8)
    known, rated_items = fz.load_factors(spark, store.path), fz.load_factors(spark, str(tmp_path / "i"))
    assert {(r.user_id, tuple(r.factors)) for r in known.collect()} == {(r.user_id, tuple(r.factors)) for r in users.collect()}
    # The plan names the buckets only where it reads one task a bucket.
    with settings(spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
        found = fz.factor_lookup(known, [3])
        assert "SelectedBucketsCount: 1 out of 8" in executed(found) and found.count() == users.where("user_id = 3").count()

    ids = rated.select("user_id").where("user_id < 9").distinct()
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", skew.BROADCAST_ROWS_SETTING: "0"}):
        lines = executed(fz.factor_lookup(known, ids)).splitlines()
        join, scan = (next(k for k, line in enumerate(lines) if word in line) for word in ("SortMergeJoin", "Bucketed: true"))
        # The factors are the join's first side: nothing is shuffled between it and their scan.
        assert scan > join and not any("Exchange" in line for line in lines[join:scan])
        stored = {(r.user_id, r.item_id): r.score for r in fz.als_predict(rated, known, rated_items).collect()}
    plain = {(r.user_id, r.item_id): r.score for r in fz.als_predict(rated, users, items).collect()}
    assert stored.keys() == plain.keys() and all(abs(stored[k] - plain[k]) < 1e-12 for k in plain)


def test_dense_positions_follow_the_ids(spark):
    ids = [2**62, -5, 7, 10**15, 7]
    rows = spark.createDataFrame([(u, k % 2, 1 + k) for k, u in enumerate(ids)], "user_id bigint, item_id bigint, rating int")
    assert {(r.user_id, r.position) for r in cl.user_positions(rows).collect()} == {(-5, 0), (7, 1), (10**15, 2), (2**62, 3)}
    found = {r.item_id: (r.size, dict(zip(r.indices, r["values"]))) for r in cl.dense_item_vectors(rows).collect()}
    assert found == {0: (4, {3: 1.0, 1: 4.0}), 1: (4, {0: 2.0, 2: 4.0})}
    assert {r.item_id for r in cl.kmeans_mllib(cl.dense_item_vectors(rows), k=2, iterations=2).collect()} == {0, 1}


def test_distinct_counts_take_one_scan(spark, rated, tmp_path):
    rated.write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    exact = rt.rating_stats(stored)
    assert executed(exact).count("FileScan") == 1
    row = exact.first()
    assert tuple(row) == (rated.select("user_id").distinct().count(), rated.select("item_id").distinct().count(), rated.count())
    # Sketches of two halves, made apart, give what one of the whole gives.
    halves = [rt.rating_sketches(stored.where(f"user_id % 2 = {k}"), "rating") for k in (0, 1)]
    merged = rt.merged_stats(halves[0].unionByName(halves[1])).first()
    assert tuple(merged) == tuple(rt.merged_stats(rt.rating_sketches(stored)).first())
    assert abs(merged.users - row.users) <= 2 and abs(merged["items"] - row["items"]) <= 2 and merged.n == row.n
    nothing = stored.where("false")
    assert tuple(rt.rating_stats(nothing).first()) == (0, 0, 0)


def test_lists_without_a_long_key_shuffle_their_rows_once(spark, rated, skewed):
    rows = rated.select("user_id", "item_id").where("user_id < 9")
    found = skew.bags_in_parts(rows, ["user_id"], F.col("item_id"), "items")
    assert found.whole is (rows.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 15)
    with settings(spark, {skew.BAG_ROWS_SETTING: "1000"}):
        found = skew.bags_in_parts(rated.select("user_id", "item_id"), ["user_id"], F.col("item_id"), "items")
        # The other exchange is the fixture's own repartition.
        assert found.whole and executed(found.rows).count("Exchange hashpartitioning") == 1


def test_keys_that_share_a_bucket_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(skew, "BUCKETS", 1)
    rows = spark.createDataFrame([(k % 3, k) for k in range(30)] + [(9, k) for k in range(25)], "k bigint, v bigint")
    with settings(spark, {skew.BAG_ROWS_SETTING: "20"}):
        found = {(r.k, r.part): list(r.vs) for r in skew.bags(rows, ["k"], F.col("v"), "vs").collect()}
    assert found.keys() == {(0, 0), (1, 0), (2, 0), (9, 0), (9, 1)} and found[9, 1] == list(range(20, 25))
    with settings(spark, {skew.BAG_ROWS_SETTING: "40"}):
        assert skew.with_parts(rows, ["k"], "v").whole
