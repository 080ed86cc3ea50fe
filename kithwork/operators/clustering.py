"""Clustering of items by who rated them and how.

An item is a point with one coordinate per user. Neither points nor centres are ever held whole:
the iterations keep both in long form (user by user), so their width may grow with the users.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from kithwork.functions import spread_hash
from kithwork.session import cut_lineage, settings, shared_folder

from .ordering import numbered
from .skew import bags, join_splits, laid_out, lookup, measure, spread_join

# Fixed values of the original job: clusters, iterations, samples per cluster.
CLUSTERS = 10
ITERATIONS = 20
SAMPLES = 5
# Distances are compared to this many digits, lower cluster first on a tie.
DIGITS = 9
# Distances are kept to DIGITS, so a bound is widened by more than that, and a clear lead is larger still.
SLACK = 1e-8
APART = 1e-6
# The library's iterations end where no centre moves further than this.
TOLERANCE = 1e-4


def _points(ratings: DataFrame) -> DataFrame:
    """One value per (item, user); repeated ratings are averaged."""
    return ratings.groupBy("item_id", "user_id").agg(F.avg("rating").alias("value"))


def item_vectors(ratings: DataFrame, size: int | None = None, first_user: int = 1) -> DataFrame:
    """``(item_id, part, size, indices, values)``: one sparse vector over users per item.

    Users are numbered from ``first_user``; the size is their count up to the largest id unless given.
    The vector of an item with very many ratings comes in several parts with disjoint positions.
    """
    position = (F.col("user_id") - first_user).cast("bigint")
    width = F.lit(size) if size is not None else ratings.agg(F.max("user_id") - first_user + 1).scalar()
    return _vectors(_points(ratings).withColumn("position", position), width)


def user_positions(ratings: DataFrame) -> DataFrame:
    """``(user_id, position)``: the users numbered from 0 without gaps, in order of their ids."""
    return numbered(ratings.select("user_id").where("user_id is not null").distinct(), "user_id", "position")


def dense_item_vectors(ratings: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """``item_vectors`` whose width is the number of users, however wide apart their ids are.

    ``positions`` defaults to ``user_positions``; keep that table to read the vectors' positions as users.
    """
    positions = cut_lineage(user_positions(ratings)) if positions is None else positions
    points = spread_join(_points(ratings), positions, "user_id", left_hot=measure(ratings, "user_id")[0])
    return _vectors(points, positions.agg(F.count(F.lit(1))).scalar())


def _vectors(points: DataFrame, width: Column) -> DataFrame:
    entry = F.struct(F.col("position").alias("i"), F.col("value").alias("x"))
    return bags(points, ["item_id"], entry, "entries").select(
        "item_id", "part", width.cast("bigint").alias("size"), F.col("entries.i").alias("indices"), F.col("entries.x").alias("values")
    )


def _deltas(by_item: DataFrame, moved: DataFrame, splits: dict) -> DataFrame:
    """``(user_id, cluster, x)``: the values of moved items, added to their new cluster and taken from the old one."""
    came = F.struct("cluster", F.col("value").alias("x"))
    left = F.struct(F.col("old").alias("cluster"), (-F.col("value")).alias("x"))
    rows = lookup(by_item, moved, "item_id", splits)
    return rows.select("user_id", F.inline(F.when(F.col("old").isNull(), F.array(came)).otherwise(F.array(came, left))))


class Centres(NamedTuple):
    """Sums of the items of a cluster per user, only where there are any; the driver holds k sizes and norms."""

    sums: DataFrame  # (user_id, cluster, s)
    sizes: list[int]
    norms: list[float]
    shifts: list[float]  # how far each centre has moved


def _moved_centres(old: Centres | None, deltas: DataFrame, before: list[int], counts: list[int]) -> Centres:
    """The centres after a move of items; ``before`` and ``counts`` are the items of every cluster.

    A cluster without items keeps its centre, and starts anew when items come to it.
    """
    sizes = [count or size for count, size in zip(counts, old.sizes if old else counts)]
    rows = deltas.withColumn("s", F.lit(0.0))
    if old:
        rows = rows.unionByName(old.sums.select("user_id", "cluster", F.lit(0.0).alias("x"), "s"))
    kept = F.when(_of(before) > 0, F.col("s")).otherwise(0.0) + F.col("x")
    new = F.when(_of(counts) > 0, kept).otherwise(F.col("s"))
    sums = rows.groupBy("user_id", "cluster").agg(F.sum("s").alias("s"), F.sum("x").alias("x")).withColumn("new", new)
    shift = F.col("new") / _of(sizes) - F.col("s") / _of(old.sizes if old else sizes)
    sums = cut_lineage(sums.select("user_id", "cluster", F.col("new").alias("s"), (shift * shift).alias("shift")))
    squares = {r["cluster"]: r for r in sums.groupBy("cluster").agg(F.sum(F.col("s") * F.col("s")).alias("n"), F.sum("shift").alias("shift")).collect()}
    norms = [squares[j]["n"] / size**2 if j in squares else 0.0 for j, size in enumerate(sizes)]
    shifts = [squares[j]["shift"] ** 0.5 if j in squares else 0.0 for j in range(len(sizes))]
    return Centres(sums.where("s <> 0").drop("shift"), sizes, norms, shifts)


def _of(values: list, cluster: str = "cluster") -> Column:
    """The value of a row's cluster, from a literal, so that all iterations run the same generated code."""
    return F.get(F.lit(values), cluster)


def _measured(points: DataFrame, centres: Centres, splits: dict) -> DataFrame:
    """``(item_id, cluster, sq_dist, upper, lower)`` by |x|^2 - 2 x.c + |c|^2, all clusters in one pass.

    ``points`` are laid out by user. ``upper`` is no less than the distance to the nearest centre, ``lower`` no
    more than that to any other.
    """
    k = len(centres.sizes)
    columns = [F.expr(f"coalesce(sum(case when cluster = {j} then s end), 0D) as c{j}") for j in range(k)]
    wide = centres.sums.groupBy("user_id").agg(*columns)
    products = [F.expr(f"sum(value * coalesce(c{j}, 0D)) as p{j}") for j in range(k)]
    per_item = lookup(points, wide, "user_id", splits, "left").groupBy("item_id").agg(F.expr("sum(value * value) as square"), *products)
    twice, norms = F.lit([2.0 / size for size in centres.sizes]), F.lit(centres.norms)
    distances = F.transform(
        F.array(*(f"p{j}" for j in range(k))),
        lambda p, j: F.struct(
            F.round(F.col("square") - p * F.get(twice, j) + F.get(norms, j), DIGITS).alias("d"), j.alias("j")
        ),
    )
    near = per_item.select("item_id", F.array_sort(distances).alias("near"))
    best, second = F.get("near", F.lit(0))["d"], F.get("near", F.lit(1))["d"]
    return near.select(
        "item_id", F.get("near", F.lit(0))["j"].alias("cluster"), F.greatest(best, F.lit(0.0)).alias("sq_dist"),
        F.sqrt(F.greatest(best, F.lit(0.0)) + SLACK).alias("upper"),
        F.coalesce(F.sqrt(F.greatest(second - SLACK, F.lit(0.0))), F.lit(float("inf"))).alias("lower"),
    )


def kmeans_items(
    ratings: DataFrame, k: int = CLUSTERS, iterations: int = ITERATIONS, seed: int = 11
) -> DataFrame:
    """``(item_id, cluster, sq_dist)`` after the given iterations.

    The start centres are k items in pseudo-random order of their ids; a cluster that loses all its
    items keeps its centre. The driver sees k counts, norms and shifts per iteration, nothing that grows
    with the data.

    An iteration adds the values of the items that changed cluster to the sums, and measures only items that
    may change: by the triangle inequality no centre can come nearer than the lower bound less its shift.
    Where no item has changed the later iterations cannot differ and are left out.
    """
    points = cut_lineage(_points(ratings))
    order = [spread_hash(F.col("item_id"), seed), F.col("item_id")]
    # The window numbers the k start items only.
    number = F.row_number().over(Window.orderBy(*order)) - 1
    seeds = points.select("item_id").distinct().orderBy(*order).limit(k)
    assigned = cut_lineage(seeds.select("item_id", number.alias("cluster"), F.lit(None).cast("int").alias("old")))
    n_seeds = assigned.count()
    if not n_seeds:
        return assigned.select("item_id", "cluster", F.lit(0.0).alias("sq_dist"))
    return _iterate(points, assigned, [1] * n_seeds, iterations)


def _iterate(
    points: DataFrame, assigned: DataFrame, counts: list[int], iterations: int, start: Centres | None = None, tolerance: float | None = None
) -> DataFrame:
    """``(item_id, cluster, sq_dist)`` after the iterations that follow the items ``assigned``, ``counts`` by cluster.

    ``start`` holds the centres before them, if there are any. They also end where no centre moves further than
    the tolerance.
    """
    user_splits, item_splits = (join_splits(points.sparkSession, hot) for hot in measure(points, "user_id", "item_id"))
    by_user = laid_out(points, "user_id", user_splits).persist(StorageLevel.MEMORY_AND_DISK)
    by_item = laid_out(points, "item_id", item_splits).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _iterations(by_user, by_item, user_splits, item_splits, assigned, counts, iterations, start, tolerance)
    finally:
        by_user.unpersist()
        by_item.unpersist()


def _iterations(
    by_user: DataFrame, by_item: DataFrame, user_splits: dict, item_splits: dict, assigned: DataFrame, counts: list[int],
    iterations: int, centres: Centres | None, tolerance: float | None,
) -> DataFrame:
    k = len(counts)
    before, items, moved = [0] * k, None, k
    for number in range(1, iterations + 1):
        changed = assigned.where("old is null or old <> cluster").select("item_id", "cluster", "old")
        centres = _moved_centres(centres, _deltas(by_item, changed, item_splits), before, counts)
        last = number == iterations or not moved or (tolerance is not None and max(centres.shifts) <= tolerance)
        if last or items is None:
            points, still = by_user, None
        else:
            assigned, n_active = _with_bounds(assigned, centres.shifts)
            # Where most items must be measured, points that are laid out by user save a shuffle of points.
            few = 2 * n_active < items
            still = assigned.where("not active").select("item_id", "cluster", F.col("cluster").alias("old"), "upper", "lower") if few else None
            points = lookup(by_item, assigned.where("active").select("item_id"), "item_id", item_splits) if few else by_user
        found = _measured(points, centres, user_splits if points is by_user else {})
        if last:
            break
        found = found.drop("sq_dist").join(assigned.select("item_id", F.col("cluster").alias("old")), "item_id", "left")
        assigned = cut_lineage(found.unionByName(still) if still is not None else found)
        changes = F.count_if(F.col("old").isNull() | (F.col("old") != F.col("cluster")))
        sizes = {r["cluster"]: (r["n"], r["m"]) for r in assigned.groupBy("cluster").agg(F.count("*").alias("n"), changes.alias("m")).collect()}
        before, counts = counts, [sizes.get(j, (0, 0))[0] for j in range(k)]
        items, moved = sum(counts), sum(m for _, m in sizes.values())
    return cut_lineage(found.select("item_id", "cluster", "sq_dist"))


def _with_bounds(assigned: DataFrame, shifts: list[float]) -> tuple[DataFrame, int]:
    """``assigned`` with bounds that hold for the moved centres and ``active`` where an item may change; their number."""
    shifts = [shift * (1 + SLACK) + SLACK for shift in shifts]
    others = [max((s for i, s in enumerate(shifts) if i != j), default=0.0) for j in range(len(shifts))]
    rows = assigned.withColumns({"upper": F.col("upper") + _of(shifts), "lower": F.greatest(F.col("lower") - _of(others), F.lit(0.0))})
    # Squares further apart than rounding could hide.
    safe = F.col("lower") * F.col("lower") - F.col("upper") * F.col("upper") > APART * (F.col("upper") * F.col("upper") + 1)
    rows = rows.withColumn("active", ~safe)
    return rows, rows.where("active").count()


def kmeans_cost(assigned: DataFrame) -> DataFrame:
    """``(cost)``: the within-cluster sum of squares, in one row."""
    return assigned.agg(F.sum("sq_dist").alias("cost"))


def cluster_samples(assigned: DataFrame, movies: DataFrame, per_cluster: int = SAMPLES) -> DataFrame:
    """``(cluster, item_id, title, genres)``: the first items of every cluster, by id, with details.

    Every task keeps its own first items per cluster before the shuffle.
    """
    order = Window.partitionBy("cluster").orderBy("item_id")
    first = assigned.select("cluster", "item_id", F.row_number().over(order).alias("n")).where(F.col("n") <= per_cluster)
    first = cut_lineage(first.drop("n"))
    return spread_join(first, movies, "item_id").select("cluster", "item_id", "title", "genres")


def sample_lines(samples: DataFrame) -> DataFrame:
    """``(cluster, value)``: ``id,title,genres`` of the samples of every cluster."""
    return samples.select("cluster", F.concat_ws(",", F.col("item_id").cast("string"), "title", "genres").alias("value"))


def kmeans_mllib(
    vectors: DataFrame, k: int = CLUSTERS, iterations: int = ITERATIONS, seed: int = 11
) -> DataFrame:
    """``(item_id, cluster)`` as Spark's own KMeans gives them over whole ``item_vectors``.

    The library chooses the start centres and finds their items. It would send dense sums, clusters x width, to the
    driver in each iteration: the iterations run as those of ``kmeans_items``, and end where the library's do.

    The k dense start centres live on the driver and the library's vectors have 32-bit positions: wider data is for
    ``kmeans_items``. The vectors are stored once in the layout of the vector type, without Python.
    """
    run = F.struct("part", F.col("indices").cast("array<int>").alias("i"), F.col("values").alias("x"))
    runs = F.sort_array(F.collect_list(run))
    whole = vectors.groupBy("item_id").agg(F.max("size").cast("int").alias("size"), runs.alias("runs"))
    # The number stands for the item in all joins, also where its id is null.
    stored = whole.select("item_id", F.monotonically_increasing_id().alias("number"), F.struct(
        F.lit(0).cast("tinyint").alias("type"), "size", F.flatten("runs.i").alias("indices"), F.flatten("runs.x").alias("values")
    ).alias("features"))
    spark = vectors.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/vectors-{uuid.uuid4().hex}"
    stored.write.parquet(path)
    plain = spark.read.schema(stored.schema).parquet(path)
    schema = StructType([*stored.schema.fields[:2], StructField("features", VectorUDT())])
    features = spark.read.schema(schema).parquet(path)
    start = KMeans(k=k, maxIter=0, seed=seed).fit(features)
    found = start.transform(features).select(F.col("number").alias("item_id"), F.col("prediction").alias("cluster"))
    if iterations:
        assigned = cut_lineage(found.withColumn("old", F.lit(None).cast("int")))
        centres = _start_centres(spark, start, f"{path}-start")
        sizes = {r["cluster"]: r["count"] for r in assigned.groupBy("cluster").count().collect()}
        counts = [sizes.get(j, 0) for j in range(len(centres.sizes))]
        found = _iterate(_entries(plain), assigned, counts, iterations, centres, TOLERANCE)
    names = plain.select(F.col("number"), F.col("item_id").alias("name"))
    return found.join(names, F.col("item_id") == F.col("number")).select(F.col("name").alias("item_id"), "cluster")


def _entries(stored: DataFrame) -> DataFrame:
    """``(item_id, user_id, value)``: the entries of stored vectors, by the numbers of the items; a missing value is 0.

    A vector without entries comes with a 0, so that it has a cluster too.
    """
    entry = F.explode_outer(F.arrays_zip("features.indices", "features.values"))
    entries = stored.select(F.col("number").alias("item_id"), entry.alias("e"))
    position = F.coalesce(F.col("e.indices"), F.lit(0)).cast("bigint")
    return entries.select("item_id", position.alias("user_id"), F.coalesce(F.col("e.values").cast("double"), F.lit(0.0)).alias("value"))


def _start_centres(spark: SparkSession, model: KMeansModel, path: str) -> Centres:
    """The centres of a fitted model, each as a cluster of one item, by way of its stored form: none comes back to the driver."""
    # A task writes one centre.
    with settings(spark, {"spark.sql.leafNodeDefaultParallelism": str(model.getK())}):
        model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    entries = stored.select(F.col("clusterIdx").alias("cluster"), F.posexplode(vector_to_array("clusterCenter")).alias("user_id", "s"))
    sums = cut_lineage(entries.where("s <> 0").select(F.col("user_id").cast("bigint"), "cluster", "s"))
    n = stored.count()
    return Centres(sums, [1] * n, [0.0] * n, [0.0] * n)
