"""Views that a registered query builds from the given tables, where keys are many or far apart."""

from pyspark.sql import functions as F

import registry.queries
from registry import views


def tables(spark, folder, orders, lines):
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_wide_user_ids_do_not_overflow(spark, tmp_path):
    last = registry.queries.WIDE_UP_TO
    users = [0, 1, last, last + 1, 90_000, 6_000_000, 2**32]
    sf = tables(spark, tmp_path, [(k, u) for k, u in enumerate(users)], [(k, i, 3.0 + i + k) for k in range(len(users)) for i in range(2, 26)])
    found = {r.position: r.user_id for r in registry.queries.user_positions(spark, sf).collect()}
    wide = [found[k] for k in range(len(users))]
    assert wide == sorted(set(wide)) and wide[:3] == [u * 300_000_000_000_000 for u in users[:3]]
    rows = registry.queries.dense_item_vectors(spark, sf).collect()
    assert {(r.item_id, r["size"], len(r.entries.split(","))) for r in rows} == {(i, len(users), len(users)) for i in range(2, 26)}
    assert registry.queries.kmeans_mllib_dense(spark, sf).where("in_range").count() == 24


def test_ratings_are_dealt_out_before_they_are_grouped(spark, tmp_path, monkeypatch):
    lines = [(k % 50, k % 9, float(k % 7)) for k in range(900)]
    sf = tables(spark, tmp_path, [(k, k % 20) for k in range(50)], lines)
    monkeypatch.setattr(views, "RATED_ROWS", 90, raising=False)
    rows = views.view(spark, sf, "ratings")
    best = {}
    for order, item, quantity in lines:
        key = (order % 20, item)
        best[key] = max(best.get(key, 0), 1 if item % 40 < 2 else 1 + int(quantity) % 5)
    assert {(r.user_id, r.item_id): r.rating for r in rows.collect()} == best and rows.schema["rating"].dataType.typeName() == "integer"
    # Each of the ten tasks groups its own rows: no task that reads tables holds groups.
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above = plan[: plan.index("Exchange hashpartitioning(user_id")]
    assert above.count("HashAggregate") == 2 and "HashAggregate" not in plan[len(above):]
    assert rows.select(F.spark_partition_id()).distinct().count() > 4
