"""Ages of users and of their friends. ``profiles`` carries ``birth_year`` and ``birth_month``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kithwork.functions import age_units, street_address
from kithwork.functions.columns import units_per_year

from .skew import spread_join

# Fixed values of the original report: year and month the ages refer to, length of the report.
AS_OF = (2016, 2)
TOP_USERS = 20


def profile_age(profiles: DataFrame, as_of: tuple[int, int] = AS_OF, unit: str = "month") -> DataFrame:
    """``(uid, age)`` in years; ``unit='month'`` counts the months too, ``'year'`` does not."""
    units = age_units(F.col("birth_year"), F.col("birth_month"), as_of, unit)
    return profiles.select("uid", (units / units_per_year(unit)).alias("age"))


def friend_age_avg(
    edges: DataFrame, profiles: DataFrame, as_of: tuple[int, int] = AS_OF, unit: str = "month"
) -> DataFrame:
    """``(uid, avg_age, n)`` over the friends that have a profile; users without any are left out.

    Whole months (or years) are summed and divided once, so the average does not depend on the
    order in which tasks finish.
    """
    units = age_units(F.col("birth_year"), F.col("birth_month"), as_of, unit)
    ages = profiles.select(F.col("uid").alias("friend"), units.alias("units")).where(F.col("units").isNotNull())
    known = spread_join(edges.select("uid", "friend"), ages, "friend")
    sums = known.groupBy("uid").agg(F.sum("units").alias("total"), F.count(F.lit(1)).alias("n"))
    return sums.select("uid", (F.col("total") / (F.col("n") * units_per_year(unit))).alias("avg_age"), "n")


def top_friend_age(
    edges: DataFrame,
    profiles: DataFrame,
    as_of: tuple[int, int] = AS_OF,
    unit: str = "month",
    n: int = TOP_USERS,
    rank_on: str = "exact",
) -> DataFrame:
    """``(rank, uid, address, avg_age)``: the users with the oldest friends, lower id first on a tie.

    Only users with a profile of their own are ranked. ``rank_on='rounded'`` ranks on two decimals.
    """
    averages = friend_age_avg(edges, profiles, as_of, unit)
    if rank_on == "rounded":
        averages = averages.withColumn("avg_age", F.round("avg_age", 2))
    elif rank_on != "exact":
        raise ValueError(f"rank_on must be 'exact' or 'rounded', not {rank_on!r}")
    order = [F.desc("avg_age"), F.asc("uid")]
    top = averages.join(profiles.select("uid"), "uid", "left_semi").orderBy(*order).limit(n)
    # The window numbers the n rows of the report only; only their addresses are looked up.
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    address = street_address(F.col("street"), F.col("city"), F.col("state")).alias("address")
    return profiles.join(F.broadcast(top), "uid").select("rank", "uid", address, "avg_age")


def report_lines(top: DataFrame, rounded: bool = True) -> DataFrame:
    """``(rank, uid, text)``: address and average age of ``top_friend_age`` as text, with two decimals (halves up) if ``rounded``."""
    age = F.format_string("%.2f", "avg_age") if rounded else F.col("avg_age").cast("string")
    return top.select("rank", "uid", F.concat_ws(", ", "address", age).alias("text"))
