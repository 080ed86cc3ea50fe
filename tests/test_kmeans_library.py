"""``kmeans_mllib``: the clusters of the library's own run, without its sums on the driver."""

import math
import os
import subprocess
import sys

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from kithwork.operators import clustering as cl

NARROW_DRIVER = """
from kithwork.operators import clustering as cl
from kithwork.session import local_session

spark = local_session(cores=4, shuffle_partitions=4, memory="2g")
rows = spark.range(2000).selectExpr("(id * 7919) % 400000 user_id", "id % 40 item_id", "1 + id % 5 rating")
vectors = cl.item_vectors(rows.unionByName(spark.sql("select 399999L user_id, 0L item_id, 5L rating")), first_user=0)
found = cl.kmeans_mllib(vectors, k=10, iterations=2).collect()
assert sorted(r.item_id for r in found) == list(range(40)) and {r.cluster for r in found} <= set(range(10))
print("whole")
"""


def test_sums_as_wide_as_the_users_are_not_sent_to_the_driver(tmp_path):
    """The library sends 10 x 400,000 x 8 bytes in an iteration; the driver takes 8 MB of a job."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(cl.__file__)))
    env = {**os.environ, "PYTHONPATH": os.path.dirname(root), "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_SUBMIT_ARGS": "--conf spark.driver.maxResultSize=8m pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", NARROW_DRIVER], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-1:] == ["whole"], done.stderr[-2000:]


def recorded_fit(monkeypatch):
    """The frames that are given to the library."""
    frames = []

    class Recorded(KMeans):
        def fit(self, dataset, params=None):
            frames.append(dataset)
            return super().fit(dataset, params)

    monkeypatch.setattr(cl, "KMeans", Recorded)
    return frames


def wandering(n=240, users=12):
    """Ratings along a bent line, no two items alike: clusters creep along it for many iterations."""
    rows = []
    for i in range(n):
        t = 6 * i / n
        rows += [(u, i, round(3 + 2 * math.sin(t * (1 + u / 70) / 3 + u) + 0.001 * ((i * 31 + u * 17) % 97), 3)) for u in range(users)]
    return rows


@pytest.mark.parametrize("settings,k,iterations", [("skewed", 4, 20), ("spark", 4, 3), ("spark", 3, 0)])
def test_clusters_are_those_of_the_library(spark, monkeypatch, request, settings, k, iterations):
    request.getfixturevalue(settings)
    frames = recorded_fit(monkeypatch)
    rows = spark.createDataFrame(wandering(), "user_id bigint, item_id bigint, rating double")
    found = {r.item_id: r.cluster for r in cl.kmeans_mllib(cl.item_vectors(rows, first_user=0), k=k, iterations=iterations).collect()}
    library = KMeans(k=k, maxIter=iterations, seed=11).fit(frames[0])
    assert found == {r.item_id: r.prediction for r in library.transform(frames[0]).collect()} and len(found) == 240
    if iterations == 20:
        assert 3 < library.summary.numIter < 20


def test_items_alike_without_ratings_or_without_an_id(spark, monkeypatch):
    frames = recorded_fit(monkeypatch)
    sides = [(None, [0, 1], [5.0, 5.0]), (1, [0, 1], [5.0, 5.0]), (2, [], []), (3, [2], [0.0]), (4, [2, 3], [None, 4.0]), (5, [3], [4.0])]
    vectors = spark.createDataFrame([(i, 0, 4, n, x) for i, n, x in sides], "item_id bigint, part int, size bigint, indices array<bigint>, `values` array<double>")
    found = {r.item_id: r.cluster for r in cl.kmeans_mllib(vectors, k=5, iterations=5).collect()}
    library = KMeans(k=5, maxIter=5, seed=11).fit(frames[0])
    assert found == {r.item_id: r.prediction for r in library.transform(frames[0]).select("item_id", F.col("prediction")).collect()}
    assert len(found) == 6 and found[None] == found[1] and found[2] == found[3] and found[4] == found[5]


def test_a_start_centre_without_items_keeps_its_place(spark):
    points = spark.createDataFrame([(i, 0, x) for i, x in enumerate([1.0, 1.0, 1.0, 45.0])], "item_id bigint, user_id bigint, value double")
    assigned = points.select("item_id", F.lit(0).alias("cluster"), F.lit(None).cast("int").alias("old"))
    start = cl.Centres(spark.createDataFrame([(0, 0, 32.0), (0, 1, 60.0)], "user_id bigint, cluster int, s double"), [1, 1], [0.0, 0.0], [0.0, 0.0])
    # The first centre moves to 12, so that 45 is nearer to the other, which no item had.
    found = {r.item_id: (r.cluster, r.sq_dist) for r in cl._iterate(points, assigned, [4, 0], 20, start, cl.TOLERANCE).collect()}
    assert found == {0: (0, 0.0), 1: (0, 0.0), 2: (0, 0.0), 3: (1, 0.0)}
