"""Session helpers: a local session for tests and benches, and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kithwork")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; only a local session may fall back to its own."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="kithwork-")
        atexit.register(shutil.rmtree, _own_folders[context.applicationId], ignore_errors=True)
    return _own_folders[context.applicationId]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for the plans that are made and run inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def id_frame(spark: SparkSession, **columns: list[int]) -> DataFrame:
    """A small frame of ids given as job arguments; Catalyst knows that it is small."""
    names = list(columns)
    rows = F.arrays_zip(*(_ids(columns[name]).alias(name) for name in names))
    return spark.range(1).select(F.explode(rows).alias("row")).select(*(F.col(f"row.{name}") for name in names))


def _ids(values: list[int]) -> Column:
    return F.lit([int(v) for v in values]).cast("array<bigint>")
