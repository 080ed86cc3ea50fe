"""Rating prediction by alternating least squares on the explicit normal equations.

Up to ``MAX_EXPRESSION_RANK`` the ratings are packed as arrays, see ``cells``. Above it they are cached twice, dealt to as
many groups of users, or of items, as tasks run at once. A group's ratings lie in blocks of the other side's ids, sorted
like the stored factors, so a half-round is one task per group that merges the factors with the group's ratings block by
block, sums the k x k products of its ids and solves their systems. Neither sums nor copies of factors are shuffled: a
factor is shuffled and stored once a half-round, to lie in its block, and read once by every group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession, functions as F

from kithwork.functions import dot, spread_hash
from kithwork.functions.columns import HASH_MODULUS
from kithwork.session import cut_lineage, settings

from . import cells
from .cells import block_numbers as _block_numbers
from .skew import join_splits, measure, spread_join, tag_hot

# Fixed values of the original job: rank, regularisation, rounds, constant start value.
RANK = 5
REGULARISATION = 1.0
ROUNDS = 10
CONSTANT_START = 0.5
# Above this rank sums are rows that can spill, no longer packed arrays, and the solve moves from column expressions to batches.
MAX_EXPRESSION_RANK = 8
# Adaptive plans do not tell how their cached or stored rows are partitioned and sorted.
AS_PLANNED = {"spark.sql.adaptive.enabled": "false"}
# A join by (block, id) may use rows that are partitioned by block alone, and a union keeps the tasks of its sides apart.
BY_BLOCK = {**AS_PLANNED, "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.unionOutputPartitioning": "false"}


def _names(k: int) -> list[str]:
    return [f"f{i}" for i in range(k)]


def start_factors(ids: DataFrame, key: str, k: int = RANK, init: str = "hashed", seed: int = 7) -> DataFrame:
    """One start vector per id: all 0.5, or a reproducible pseudo-random one."""
    if init == "constant":
        values = [F.lit(CONSTANT_START) for _ in range(k)]
    elif init == "hashed":
        values = [spread_hash(F.col(key), seed, stream) / HASH_MODULUS for stream in range(k)]
    else:
        raise ValueError(f"init must be 'constant' or 'hashed', not {init!r}")
    return ids.select(key, *(v.alias(name) for v, name in zip(values, _names(k))))


class Blocks(NamedTuple):
    """Ratings in groups of one side's ids, each in blocks of the other side's ids."""

    ratings: DataFrame  # (block, key, by, rating, group), partitioned by block
    groups: list[DataFrame]  # the ratings of every group, partitioned by block and sorted by (block, by)
    routes: DataFrame  # (by) of all ratings, once each
    key: str
    by: str
    split: list  # ids whose ratings are spread over several groups
    numbers: list[int]

    def unpersist(self) -> None:
        for frame in (self.ratings, *self.groups):
            frame.unpersist()


def _tasks(spark: SparkSession) -> int:
    """Blocks and groups: no more than tasks run at once, as every group reads all factors."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


def _in_block(df: DataFrame, by: str, numbers: list[int]) -> DataFrame:
    """``df`` partitioned by the block of ``by`` and sorted in it."""
    block = F.get(F.lit(numbers), F.pmod(F.xxhash64(by), F.lit(len(numbers))).cast("int")).cast("bigint")
    return df.withColumn("block", block).repartition(len(numbers), "block").sortWithinPartitions("block", by)


def in_blocks(ratings: DataFrame, key: str, by: str, splits: dict, numbers: list[int]) -> Blocks:
    """Groups of about equal size: an id belongs to one, a hot one (``splits``) to several, by the rating's own hash."""
    salted = tag_hot(ratings, key, splits, "_s") if splits else ratings.withColumn("_s", F.lit(0))
    group = F.pmod(F.hash(key, "_s"), F.lit(len(numbers)))
    with settings(ratings.sparkSession, AS_PLANNED):
        rows = _in_block(salted.select(key, by, "rating", group.alias("group")), by, numbers).persist(StorageLevel.MEMORY_AND_DISK)
        groups = [rows.where(F.col("group") == g).drop("group").persist(StorageLevel.MEMORY_AND_DISK) for g in range(len(numbers))]
    return Blocks(rows, groups, rows.select(by).distinct(), key, by, list(splits), numbers)


def _store(factors: DataFrame, key: str, numbers: list[int]) -> DataFrame:
    """Factors stored in the blocks of their ids, sorted: ``normal_sums`` reads them without a shuffle or a sort."""
    return cut_lineage(_in_block(factors, key, numbers))


def normal_sums(blocks: Blocks, factors: DataFrame, k: int) -> DataFrame:
    """Sums of factor products (``a_i_j``, upper triangle) and of rating x factor (``b_i``) per id of the blocks.

    Needs ``BY_BLOCK`` settings, so that the join by block and id stays in the block and every group is one task.
    """
    names = [f"a_{i}_{j}" for i in range(k) for j in range(i, k)] + [f"b_{i}" for i in range(k)]
    sums = [F.expr(f"sum(f{i} * f{j}) as a_{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.expr(f"sum(rating * f{i}) as b_{i}") for i in range(k)]
    placed = factors if "block" in factors.columns else _in_block(factors, blocks.by, blocks.numbers)
    placed = placed.hint("merge")
    # The task of a group merges one block after the other; it has no more in memory than the sums of the group's ids.
    merged = (rows.join(placed, ["block", blocks.by]).coalesce(1) for rows in blocks.groups)
    found = reduce(DataFrame.unionByName, (rows.groupBy(blocks.key).agg(*sums) for rows in merged))
    if not blocks.split:
        return found
    # Only ids spread over groups (at most as many as the sketch lists) have sums to add up.
    spread = F.col(blocks.key).isin(blocks.split)
    added = found.where(spread).groupBy(blocks.key).agg(*(F.sum(n).alias(n) for n in names))
    return found.where(~spread).unionByName(added)


def solve(sums: DataFrame, key: str, k: int, regularisation: float) -> DataFrame:
    """Solve ``(A + regularisation I) x = b`` in every row.

    The matrix is symmetric and positive definite, so elimination needs no pivoting. It is written as
    one select whose columns refer to earlier ones, and runs inside generated code.
    """
    if k > MAX_EXPRESSION_RANK:
        return _solve_batches(sums, key, k, regularisation)
    columns = []

    def define(name: str, text: str) -> str:
        columns.append(f"{text} as {name}")
        return name

    a = {(i, j): f"a_{i}_{j}" for i in range(k) for j in range(i, k)}
    b = [f"b_{i}" for i in range(k)]
    for i in range(k):
        a[i, i] = define(f"d_{i}", f"a_{i}_{i} + {float(regularisation)!r}D")
    for p in range(k):
        for i in range(p + 1, k):
            ratio = define(f"r_{p}_{i}", f"{a[p, i]} / {a[p, p]}")
            for j in range(i, k):
                a[i, j] = define(f"a_{p}_{i}_{j}", f"{a[i, j]} - {ratio} * {a[p, j]}")
            b[i] = define(f"b_{p}_{i}", f"{b[i]} - {ratio} * {b[p]}")
    for p in reversed(range(k)):
        known = "".join(f" - {a[p, j]} * f{j}" for j in range(p + 1, k))
        define(f"f{p}", f"({b[p]}{known}) / {a[p, p]}")
    return sums.selectExpr(key, *columns).select(key, *_names(k))


def _solve_batches(sums: DataFrame, key: str, k: int, regularisation: float) -> DataFrame:
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def solve_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a = np.zeros((len(batch), k, k))
            for i, j in upper:
                a[:, i, j] = a[:, j, i] = batch[f"a_{i}_{j}"]
            a += regularisation * np.eye(k)
            b = batch[[f"b_{i}" for i in range(k)]].to_numpy()
            x = np.linalg.solve(a, b[:, :, None])[:, :, 0]
            yield pd.DataFrame({key: batch[key], **{f"f{i}": x[:, i] for i in range(k)}})

    kind = sums.schema[key].dataType.simpleString()
    return sums.mapInPandas(solve_batch, f"`{key}` {kind}, " + ", ".join(f"f{i} double" for i in range(k)))


def _as_vectors(factors: DataFrame, key: str, k: int) -> DataFrame:
    return factors.select(key, F.array(*_names(k)).alias("factors"))


def als_factors(
    ratings: DataFrame,
    k: int = RANK,
    regularisation: float = REGULARISATION,
    rounds: int = ROUNDS,
    init: str = "hashed",
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """``(user_id, factors)`` and ``(item_id, factors)`` after the given rounds, items first.

    The regularisation is not scaled by the number of ratings. ``init='constant'`` starts every
    factor at 0.5; all factors of an id then stay equal but for rounding, which decides the later
    rounds, so the default start is pseudo-random by id.
    """
    if rounds < 1:
        raise ValueError("at least one round is needed")
    ratings = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))
    spark = ratings.sparkSession
    measured = measure(ratings, "user_id", "item_id")
    user_splits, item_splits = (join_splits(spark, hot) for hot in measured)
    if k <= MAX_EXPRESSION_RANK:
        packed = cells.Packed(ratings, measured[0].rows, (list(user_splits), list(item_splits)), k, _tasks(spark))
        try:
            return _packed_rounds(packed, regularisation, rounds, init, seed)
        finally:
            packed.remove()
    numbers = _block_numbers(spark, _tasks(spark))
    of_items = in_blocks(ratings, "item_id", "user_id", item_splits, numbers)
    of_users = in_blocks(ratings, "user_id", "item_id", user_splits, numbers)
    try:
        with settings(spark, BY_BLOCK):
            start = start_factors(of_items.routes, "user_id", k, init, seed)
            users = _store(start, "user_id", numbers)
            for number in range(1, rounds + 1):
                items = _store(solve(normal_sums(of_items, users, k), "item_id", k, regularisation), "item_id", numbers)
                users = _store(solve(normal_sums(of_users, items, k), "user_id", k, regularisation), "user_id", numbers)
                if number == 1:  # the groups hold all ratings from here on
                    of_items.ratings.unpersist()
                    of_users.ratings.unpersist()
    finally:
        of_items.unpersist()
        of_users.unpersist()
    return _as_vectors(users, "user_id", k), _as_vectors(items, "item_id", k)


def _packed_rounds(packed: cells.Packed, regularisation: float, rounds: int, init: str, seed: int) -> tuple[DataFrame, DataFrame]:
    start = start_factors(packed.ids["user_id"], "user_id", packed.k, init, seed)
    users = packed.start(start, _names(packed.k))
    for _ in range(rounds):
        items = packed.half_round(packed.items, users, regularisation)
        users = packed.half_round(packed.users, items, regularisation)
    return packed.rows(packed.users, users), packed.rows(packed.items, items)


def als_predict(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """``(user_id, item_id, score)`` for every asked pair of a known user and a known item."""
    users = user_factors.withColumnRenamed("factors", "user_factors")
    items = item_factors.withColumnRenamed("factors", "item_factors")
    hot_user, hot_item = measure(pairs, "user_id", "item_id")
    found = spread_join(pairs.select("user_id", "item_id"), users, "user_id", left_hot=hot_user)
    found = spread_join(found, items, "item_id", left_hot=hot_item)
    return found.select("user_id", "item_id", dot(F.col("user_factors"), F.col("item_factors")).alias("score"))


def als_loss(
    ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame, regularisation: float = REGULARISATION
) -> DataFrame:
    """``(loss)``: squared error plus the regularised squared size of all factors, in one row."""
    scored = ratings.select("user_id", "item_id", "rating")
    hot_user, hot_item = measure(scored, "user_id", "item_id")
    scored = spread_join(scored, user_factors.withColumnRenamed("factors", "u"), "user_id", left_hot=hot_user)
    scored = spread_join(scored, item_factors.withColumnRenamed("factors", "v"), "item_id", left_hot=hot_item)
    error = F.col("rating") - dot(F.col("u"), F.col("v"))
    squares = F.sum(dot(F.col("factors"), F.col("factors")))
    sizes = user_factors.agg(squares).scalar() + item_factors.agg(squares).scalar()
    return scored.agg(F.sum(error * error).alias("error")).select((F.col("error") + regularisation * sizes).alias("loss"))


def factor_lookup(factors: DataFrame, ids: DataFrame | list[int]) -> DataFrame:
    """The rows of a factor table for the given ids, once each; a frame of ids has the same key column.

    Of stored factors a list of ids reads the buckets they fall into, a frame of ids is dealt to the buckets.
    """
    key = factors.columns[0]
    if isinstance(ids, list):
        return factors.where(F.col(key).isin(ids))
    return factors.join(ids.select(key), key, "left_semi")


class FactorStore(NamedTuple):
    """Where factors are stored: files in buckets of the id, sorted by it."""

    path: str
    key: str
    buckets: int


def save_factors(factors: DataFrame, path: str, buckets: int | None = None) -> FactorStore:
    """Store a factor table in buckets by its id, sorted inside; an older one is replaced.

    ``buckets`` defaults to the number of shuffle partitions. A description is stored next to the buckets.
    """
    spark, key = factors.sparkSession, factors.columns[0]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    name = _table_name()
    try:
        rows = factors.select(key, "factors").repartition(buckets, key)
        rows.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", f"{path}/factors").saveAsTable(name)
    finally:
        spark.sql(f"drop table if exists {name}")
    about = spark.range(1).select(F.lit(key).alias("key"), F.lit(factors.schema[key].dataType.simpleString()).alias("kind"), F.lit(buckets).alias("buckets"))
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return FactorStore(path, key, buckets)


def load_factors(spark: SparkSession, path: str) -> DataFrame:
    """A stored factor table. Joins by id read its buckets in place, a filter on ids reads only their buckets."""
    about = spark.read.parquet(f"{path}/about").first()
    key, name = about["key"], _table_name()
    spark.sql(
        f"create table {name} (`{key}` {about['kind']}, factors array<double>) using parquet "
        f"clustered by (`{key}`) sorted by (`{key}`) into {about['buckets']} buckets location '{path}/factors'"
    )
    return spark.table(name)


def _table_name() -> str:
    return f"kithwork_factors_{uuid.uuid4().hex}"


def als_mllib(
    ratings: DataFrame, k: int = RANK, regularisation: float = REGULARISATION, rounds: int = ROUNDS, seed: int = 7
) -> tuple[DataFrame, DataFrame]:
    """The factor tables of Spark's own ALS, which scales the regularisation by the number of ratings.

    It takes 32-bit ids only; wider ids are for ``als_factors``.
    """
    model = ALS(
        rank=k, maxIter=rounds, regParam=regularisation, seed=seed,
        userCol="user_id", itemCol="item_id", ratingCol="rating",
    ).fit(ratings.select("user_id", "item_id", "rating"))

    def named(factors: DataFrame, key: str) -> DataFrame:
        return factors.select(F.col("id").cast("bigint").alias(key), F.col("features").cast("array<double>").alias("factors"))

    return named(model.userFactors, "user_id"), named(model.itemFactors, "item_id")
