"""Line scans and the parsers that turn lines into typed rows.

Every parser takes a frame with a ``value`` column. Fields that fail to convert are never an error: a row without
the values its layout needs is left out, one that lost another value (a birth date, one friend of a list) is kept
without it. ``rejected_lines`` returns the lines of both kinds. A parser that is given ``rejects`` counts them as
its rows pass by, in the scan that the job does anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from kithwork.functions import split_fields


# Name of the observed count.
REJECTED = "rejected"
# The columns a row of a layout cannot do without, and those whose loss is reported.
NEEDED = {
    "profiles": ["uid"],
    "labeled": ["id", "label", "features"],
    "movies": ["item_id"],
    "ratings": ["user_id", "item_id", "rating"],
    "users": ["user_id"],
}
REPORTED = {**NEEDED, "profiles": ["uid", "birth_month", "birth_year"]}


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spread_splits(spark.read.text(list(paths)))


def spread_splits(scan: DataFrame, *keys: str) -> DataFrame:
    """Repartition a file scan that has far fewer splits than there are cores, else leave it alone.

    A compressed text file, or a table file of one row group, is read by one task whatever its
    size; large inputs have many splits and are never moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(cores, *keys) if splits * 2 <= cores else scan


def _field(parts: str, index: int) -> Column:
    return F.get(F.col(parts), F.lit(index))


def _adjacency(lines: DataFrame) -> DataFrame:
    parts = lines.select("value", split_fields(F.col("value"), "\t").alias("parts"))
    return parts.select(
        "value",
        _field("parts", 0).try_cast("bigint").alias("uid"),
        F.transform(
            split_fields(_field("parts", 1), ","), lambda friend: friend.try_cast("bigint")
        ).alias("friends"),
    )


def count_rejects(rows: DataFrame, bad: Column, rejects: Observation | None) -> DataFrame:
    """``rows``; the number of those that are ``bad`` is in ``rejects`` once a job has read them all."""
    return rows if rejects is None else rows.observe(rejects, F.count_if(bad).alias(REJECTED))


def adjacency_edges(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``uid<TAB>f1,f2,...`` -> one row per listed friend. Repeats and self-loops are kept."""
    rows = _adjacency(lines)
    rows = count_rejects(rows, _bad_adjacency(), rejects).where(F.col("uid").isNotNull())
    return rows.select("uid", F.explode("friends").alias("friend")).where(
        F.col("friend").isNotNull()
    )


def _bad_adjacency() -> Column:
    bad_friend = F.exists("friends", lambda friend: friend.isNull())
    return F.col("uid").isNull() | F.coalesce(bad_friend, F.lit(False))


def _profiles(lines: DataFrame) -> DataFrame:
    parts = lines.select("value", split_fields(F.col("value"), ",").alias("parts"))
    named = parts.select(
        "value",
        _field("parts", 0).try_cast("bigint").alias("uid"),
        _field("parts", 1).alias("first_name"),
        _field("parts", 2).alias("last_name"),
        _field("parts", 3).alias("street"),
        _field("parts", 4).alias("city"),
        _field("parts", 5).alias("state"),
        _field("parts", 6).alias("zip"),
        _field("parts", 9).alias("dob"),
    )
    return with_birth_date(named)


def with_birth_date(profiles: DataFrame) -> DataFrame:
    """Add ``birth_month`` and ``birth_year`` from a ``month/day/year`` text."""
    date = F.split(F.col("dob"), "/")
    return profiles.withColumns(
        {
            "birth_month": F.get(date, F.lit(0)).try_cast("int"),
            "birth_year": F.get(date, F.lit(2)).try_cast("int"),
        }
    )


def _kept(rows: DataFrame, layout: str, rejects: Observation | None) -> DataFrame:
    rows = count_rejects(rows, ~_complete(REPORTED[layout]), rejects)
    return rows.where(_complete(NEEDED[layout])).drop("value")


def parse_profiles(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """Profiles with an id; one whose birth date cannot be read has a null birth month or year."""
    return _kept(_profiles(lines), "profiles", rejects)


def _labeled(lines: DataFrame) -> DataFrame:
    parts = lines.select("value", split_fields(F.col("value"), ",").alias("parts"))
    count = F.size("parts")
    numbers = F.transform(
        F.slice("parts", F.lit(2), F.greatest(count - 2, F.lit(0))),
        lambda x: x.try_cast("double"),
    )
    return parts.select(
        "value",
        _field("parts", 0).try_cast("bigint").alias("id"),
        F.get(F.col("parts"), count - 1).try_cast("double").alias("label"),
        F.when(~F.exists(numbers, lambda x: x.isNull()), numbers).alias("features"),
    )


def parse_labeled(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``id,x1,...,xn,label`` -> id, label and the features between them."""
    return _kept(_labeled(lines), "labeled", rejects)


def _table(lines: DataFrame, sep: str, columns: list[tuple[str, str]]) -> DataFrame:
    parts = lines.select("value", split_fields(F.col("value"), sep).alias("parts"))
    return parts.select(
        "value",
        *(
            _field("parts", i).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(columns)
        ),
    )


def _movies(lines: DataFrame, sep: str) -> DataFrame:
    return _table(lines, sep, [("item_id", "bigint"), ("title", "string"), ("genres", "string")])


def parse_movies(lines: DataFrame, sep: str = "::", rejects: Observation | None = None) -> DataFrame:
    return _kept(_movies(lines, sep), "movies", rejects)


def _ratings(lines: DataFrame, sep: str) -> DataFrame:
    columns = [("user_id", "bigint"), ("item_id", "bigint"), ("rating", "int"), ("rated_at", "string")]
    return _table(lines, sep, columns)


def parse_ratings(lines: DataFrame, sep: str = "::", rejects: Observation | None = None) -> DataFrame:
    return _kept(_ratings(lines, sep), "ratings", rejects)


def _users(lines: DataFrame, sep: str) -> DataFrame:
    columns = [
        ("user_id", "bigint"), ("gender", "string"), ("age", "int"), ("occupation", "int"), ("zip", "string"),
    ]
    return _table(lines, sep, columns)


def parse_users(lines: DataFrame, sep: str = "::", rejects: Observation | None = None) -> DataFrame:
    return _kept(_users(lines, sep), "users", rejects)


def _complete(columns: list[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def rejected_lines(lines: DataFrame, layout: str, sep: str = "::") -> DataFrame:
    """The lines that lost a value: those a parser left out, and those it kept without a reported value."""
    if layout == "adjacency":
        return _adjacency(lines).where(_bad_adjacency()).select("value")
    if layout not in REPORTED:
        raise ValueError(f"unknown layout {layout!r}")
    rows = {
        "profiles": _profiles, "labeled": _labeled, "movies": lambda x: _movies(x, sep),
        "ratings": lambda x: _ratings(x, sep), "users": lambda x: _users(x, sep),
    }[layout](lines)
    return rows.where(~_complete(REPORTED[layout])).select("value")
