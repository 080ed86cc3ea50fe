"""Positions and running sums over a whole table in key order, without one task that sees all rows.

The rows are dealt to tasks by ranges of the key, counted per task, and numbered inside each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kithwork.session import cut_lineage

# monotonically_increasing_id() holds the task above this bit and the row of the task below it.
TASK_BIT = 33


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _before(order: Column | str, *keys: str):
    """All earlier rows of a window in which the rows of a key are the tasks that hold it."""
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with the number of each row, from 0 without gaps, in order of ``key``; equal keys in any order."""
    ranged = df.repartitionByRange(_tasks(df), key).sortWithinPartitions(key)
    placed = cut_lineage(ranged.withColumn("_row", F.monotonically_increasing_id()))
    task = F.shiftright("_row", TASK_BIT)
    inside = F.col("_row").bitwiseAND(F.lit((1 << TASK_BIT) - 1))
    # One row per task; the window over them has as many rows as there are tasks.
    counts = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    ahead = counts.select("_task", F.coalesce(F.sum("_n").over(_before("_task")), F.lit(0)).alias("_ahead"))
    found = placed.withColumn("_task", task).join(F.broadcast(ahead), "_task")
    return found.withColumn(name, F.col("_ahead") + inside).select(*df.columns, name)


def running_counts(values: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value, n, upto, total, distinct)`` for every distinct value of a key, in order of the values.

    ``upto`` counts the rows of the key up to the value, itself included, ``total`` all of them, ``distinct``
    the values of the key. A key with very many values is spread over tasks.
    """
    counted = values.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    ranged = cut_lineage(counted.repartitionByRange(_tasks(values), key, value).withColumn("_task", F.spark_partition_id()))
    parts = ranged.groupBy(key, "_task").agg(F.sum("n").alias("_m"), F.count(F.lit(1)).alias("_d"))
    whole = Window.partitionBy(key)
    parts = parts.select(
        key, "_task", F.coalesce(F.sum("_m").over(_before("_task", key)), F.lit(0)).alias("_ahead"),
        F.sum("_m").over(whole).alias("total"), F.sum("_d").over(whole).alias("distinct"),
    )
    inside = Window.partitionBy(key, "_task").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_inside", F.sum("n").over(inside)).join(parts, [key, "_task"])
    return summed.select(key, value, "n", (F.col("_ahead") + F.col("_inside")).alias("upto"), "total", "distinct")
