"""Joins and bags that stay balanced when one key holds a large part of all rows.

The hot keys of a side are measured first, in one scan of its key column that shuffles nothing but
one small frequency sketch per task. At most ``MAX_HOT`` keys can each hold more than
``1 / MAX_HOT`` of the rows, so the measured list has a fixed bound whatever the size of the data.
Without hot keys the plan is the plain one.

The same scan counts the rows. A side is marked for broadcast only if it was counted to be small; else
Catalyst chooses by size between a broadcast and a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kithwork.session import cut_lineage

MAX_HOT = 1024
# The sketch lists twice that many, so that its counting error cannot push out a truly hot key.
LISTED = 2 * MAX_HOT
SKETCH_ITEMS = 16 * MAX_HOT
# Buckets in which keys are counted together: no more numbers than that are shuffled by a task or collected.
BUCKETS = 1 << 16
# A key with fewer rows than this is never split; session setting, read at call time.
MIN_ROWS_SETTING = "kithwork.skew.minRows"
MIN_ROWS_DEFAULT = 200_000
# A side with more rows than this is never marked for broadcast; session setting, read at call time.
BROADCAST_ROWS_SETTING = "kithwork.broadcast.maxRows"
BROADCAST_ROWS_DEFAULT = 200_000
# Longest list kept in one row; session setting, read at call time.
BAG_ROWS_SETTING = "kithwork.bag.maxRows"
BAG_ROWS_DEFAULT = 500_000


@dataclass(frozen=True)
class HotKeys:
    """The rows of a table and its hot keys, each with about how many rows it holds."""

    rows: int
    keys: dict = field(default_factory=dict)

    def plus(self, other: HotKeys) -> HotKeys:
        keys = {key: self.keys.get(key, 0) + other.keys.get(key, 0) for key in {**self.keys, **other.keys}}
        return HotKeys(self.rows + other.rows, keys)

    def splits(self, per_task: int) -> dict:
        return {key: -(-count // per_task) for key, count in self.keys.items() if count > per_task}


def _setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def measure(df: DataFrame, *keys: str) -> list[HotKeys]:
    """One ``HotKeys`` per key column, all from a single scan of those columns."""
    sketches = [F.expr(f"approx_top_k(`{key}`, {LISTED}, {SKETCH_ITEMS})").alias(f"top_{key}") for key in keys]
    row = df.select(*keys).agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    return [
        HotKeys(row["n"], {top["item"]: top["count"] for top in row[f"top_{key}"] if top["item"] is not None})
        for key in keys
    ]


def join_splits(spark: SparkSession, hot: HotKeys) -> dict:
    """Into how many tasks the rows of each hot key go."""
    return hot.splits(max(_setting(spark, MIN_ROWS_SETTING, MIN_ROWS_DEFAULT), hot.rows // MAX_HOT))


def is_small(spark: SparkSession, rows: int) -> bool:
    return rows <= _setting(spark, BROADCAST_ROWS_SETTING, BROADCAST_ROWS_DEFAULT)


def _split_table(df: DataFrame, key: str, splits: dict, name: str) -> DataFrame:
    """The (key, number of splits) list as a frame; broadcast is safe, it has at most LISTED rows."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.sparkSession.createDataFrame(list(splits.items()), f"`{key}` {kind}, `{name}` int")
    return F.broadcast(rows)


def tag_hot(df: DataFrame, key: str, splits: dict, salt: str, only: Column | None = None) -> DataFrame:
    """Give every row one salt below the number of splits of its key, from the row's own content.

    Rows that do not meet ``only`` all have salt 0.
    """
    table = _split_table(df, key, splits, "_splits")
    value = F.pmod(F.xxhash64(*df.columns), _split_count(only))
    return df.join(table, key, "left").withColumn(salt, value.cast("int")).drop("_splits")


def copy_hot(df: DataFrame, key: str, splits: dict, salt: str, only: Column | None = None) -> DataFrame:
    """Repeat every row once per salt of its key."""
    table = _split_table(df, key, splits, "_splits")
    salts = F.sequence(F.lit(0), _split_count(only) - 1)
    return df.join(table, key, "left").withColumn(salt, F.explode(salts)).drop("_splits")


def _split_count(only: Column | None) -> Column:
    count = F.col("_splits") if only is None else F.when(only, F.col("_splits"))
    return F.coalesce(count, F.lit(1))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    left_hot: HotKeys | None = None,
    right_hot: HotKeys | None = None,
) -> DataFrame:
    """Equi-join on ``key`` that splits the rows of hot keys over several tasks.

    The rows of a key hot on the left get a salt each and the matching right rows are repeated per
    salt, and the other way round for the right, so every pair of rows still meets exactly once.
    ``right_hot`` is for inner joins only: the other kinds may repeat the right side, not the left.
    The measured frame may be larger than the joined one, never smaller.
    """
    if right_hot is not None and how != "inner":
        raise ValueError("only an inner join can split its right side")
    if left.schema[key].dataType != right.schema[key].dataType:
        right = right.withColumn(key, F.col(key).cast(left.schema[key].dataType))
    spark = left.sparkSession
    if left_hot is None:
        left_hot = measure(left, key)[0]
    if how == "inner" and is_small(spark, left_hot.rows):
        return right.join(F.broadcast(left), key)
    if right_hot is not None and is_small(spark, right_hot.rows):
        return left.join(F.broadcast(right), key)
    on = [key]
    left_splits = join_splits(spark, left_hot)
    right_splits = join_splits(spark, right_hot) if right_hot else {}
    if left_splits:
        left, right = tag_hot(left, key, left_splits, "_ls"), copy_hot(right, key, left_splits, "_ls")
        on.append("_ls")
    if right_splits:
        left, right = copy_hot(left, key, right_splits, "_rs"), tag_hot(right, key, right_splits, "_rs")
        on.append("_rs")
    return left.join(right, on, how).drop("_ls", "_rs")


class Parts(NamedTuple):
    rows: DataFrame
    whole: bool  # every key has part 0 only


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _crowded_buckets(df: DataFrame, keys: list[str], longest: int) -> list[int]:
    """Hash buckets of keys with more than ``longest`` rows: a scan of the keys that shuffles a count per bucket."""
    counts = df.groupBy(_bucket(keys).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return [row["b"] for row in counts.where(F.col("n") > longest).collect()]


def with_parts(df: DataFrame, keys: list[str], item: str) -> Parts:
    """Add ``part``: part p of a key is the p-th run of ``kithwork.bag.maxRows`` rows in order of ``item``.

    A key cannot have more rows than its hash bucket, so only keys in buckets above the limit are counted, and
    most often there are none. The sizes of large keys are exact and the positions follow the items, so the
    parts depend on the rows alone, not on how they are partitioned. Keys up to that size have part 0 only. The rows of larger keys are
    ordered by range partitions, so no task holds a whole key.
    """
    spark = df.sparkSession
    longest = _setting(spark, BAG_ROWS_SETTING, BAG_ROWS_DEFAULT)
    crowded = _crowded_buckets(df, keys, longest)
    if not crowded:
        return Parts(df.withColumn("part", F.lit(0)), True)
    suspects = df.where(_bucket(keys).isin(crowded))
    large = cut_lineage(suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > longest))
    sizes = large.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not sizes[0]:
        return Parts(df.withColumn("part", F.lit(0)), True)
    small_list = is_small(spark, sizes[0])
    names = F.broadcast(large.drop("_n")) if small_list else large.drop("_n")
    tasks = max(_setting(spark, "spark.sql.shuffle.partitions", 200), -(-sizes[1] // longest))
    ranged = df.join(names, keys, "left_semi").repartitionByRange(tasks, *keys, item)
    ranged = cut_lineage(ranged.withColumn("_task", F.spark_partition_id()))
    counts = ranged.groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(*keys, "_task", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*keys, "_task").orderBy(item)
    numbered = ranged.withColumn("_row", F.row_number().over(inside) - 1).join(ahead, [*keys, "_task"])
    part = F.floor((F.col("_ahead") + F.col("_row")) / longest).cast("int")
    numbered = numbered.withColumn("part", part).select(*df.columns, "part")
    return Parts(df.join(names, keys, "left_anti").withColumn("part", F.lit(0)).unionByName(numbered), False)


def bags(df: DataFrame, keys: list[str], item: Column, name: str) -> DataFrame:
    """Group to one sorted list per key; a very large group comes as several rows, one per ``part``.

    Part p is the p-th run of the sorted list, so the parts in order are the list.
    """
    return bags_in_parts(df, keys, item, name).rows


def bags_in_parts(df: DataFrame, keys: list[str], item: Column, name: str) -> Parts:
    """``bags``, and whether every list is in one row."""
    rows, whole = with_parts(df.select(*keys, item.alias("_item")), keys, "_item")
    items = F.sort_array(F.collect_list("_item")).alias(name)
    if whole:
        return Parts(rows.groupBy(*keys).agg(items).select(*keys, F.lit(0).alias("part"), name), True)
    return Parts(rows.groupBy(*keys, "part").agg(items), False)


def laid_out(df: DataFrame, key: str, splits: dict) -> DataFrame:
    """Partition and sort by key for repeated joins on it; the rows of hot keys carry a salt ``_s``.

    The number of partitions is given outright, so that it stays the same under adaptive execution
    and a cached copy is joined without another shuffle.
    """
    tasks = _setting(df.sparkSession, "spark.sql.shuffle.partitions", 200)
    if not splits:
        return df.repartition(tasks, key).sortWithinPartitions(key)
    return tag_hot(df, key, splits, "_s").repartition(tasks, key, "_s").sortWithinPartitions(key, "_s")


def lookup(df: DataFrame, table: DataFrame, key: str, splits: dict, how: str = "inner") -> DataFrame:
    """Join rows made by ``laid_out`` with a table of one row per key."""
    if not splits:
        return df.join(table, key, how)
    return df.join(copy_hot(table, key, splits, "_s"), [key, "_s"], how)
