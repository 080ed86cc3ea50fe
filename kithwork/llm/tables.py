"""Small helpers shared by the operators: stored intermediate tables, folds and samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kithwork.session import shared_folder

# Rows of a group beyond twice those wanted that pass the first cut of a sample.
SPARE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of a few numbers each that one task takes.
TASK_ROWS = 50_000


def few_tasks(df: DataFrame, rows: int, per_task: int = TASK_ROWS) -> DataFrame:
    """``df``, of at most ``rows`` rows, in tasks of ``per_task`` rows where those are fewer than a shuffle has.

    Rows stay where they are and tasks take several parts. Larger tables keep their tasks, and every core has one.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, 1 + rows // per_task)
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/kithwork-llm/{spark.sparkContext.applicationId}"


def remove_stored(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application, through the file system of the shared folder; whether
    there were any. To be called when the results have been written: until then they read these tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings (dots as double underscores) for what is run inside."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def matching_rows(df: DataFrame, keys: DataFrame, key: str, name: str, tasks_of: tuple[int, int] | None = None) -> DataFrame:
    """Inner join of a wide table with the few of its keys that are wanted, stored; ``tasks_of`` as for ``few_tasks``.

    Where Spark shuffles the join, it first drops most other rows of ``df`` in the scan with a Bloom filter
    of bounded size (``spark.sql.optimizer.runtime.bloomFilter.maxNumBits``), so wide rows nobody wants are
    not shuffled. ``keys`` must hold a likely selective condition for Spark to make one.
    """
    with settings(df.sparkSession, spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0"):
        rows = df.join(keys, key)
        return stored(few_tasks(rows, *tasks_of) if tasks_of else rows, name)


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def hash_sample(df: DataFrame, per_group: int, group: str, key: str) -> DataFrame:
    """At most ``per_group`` rows of each group, those with the smallest hash of ``key``.

    A group is first cut to the hashes below twice the share it needs, so that the rows that are ranked are few
    however large it is. There is a count per group, and a model holds an entry per group: they are broadcast.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("_rows"))
    place = F.xxhash64(F.col(key).cast("string"))
    share = (2.0 * per_group + SPARE) / F.col("_rows")
    near = df.join(F.broadcast(counts), group).where(place / F.lit(2.0**64) + 0.5 < share).drop("_rows")
    order = Window.partitionBy(group).orderBy(place, key)
    return near.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_group).drop("_rank").select(*df.columns)


def excerpt(text: str, key: str, max_bytes: int) -> Column:
    """A text of at most ``max_bytes`` as it is, of a longer one ``max_bytes`` / 4 characters from a place that
    follows from its key."""
    size = max_bytes // 4
    start = F.pmod(F.xxhash64(key), F.length(text) - size + 1).cast("int") + 1
    return F.when(F.octet_length(text) <= max_bytes, F.col(text)).otherwise(F.when(F.length(text) > size, F.substring(F.col(text), start, F.lit(size))).otherwise(F.col(text)))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int, max_bytes: int
) -> tuple[dict[int, list[bytes]], dict[int, int]]:
    """Texts of a bounded sample of labelled rows per class (0 and 1), and the class counts of all of them.

    Rows with ``crc32(doc_id) % modulus == held_out`` are left out. A class gives at most ``per_class`` rows,
    those with the smallest id hash; of texts above ``max_bytes`` it gives an excerpt. Only the sampled ids are
    broadcast.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    own = own.where(F.col("label").isin(0, 1) & (fold("doc_id", modulus) != held_out))
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    sample = hash_sample(own, per_class, "label", "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").withColumn("text", excerpt("text", "doc_id", max_bytes)).collect()
    rows = sorted((r["doc_id"], r["text"], r["label"]) for r in rows)
    return {c: [text.encode() for _, text, k in rows if k == c] for c in (1, 0)}, {c: counts.get(c, 0) for c in (1, 0)}
