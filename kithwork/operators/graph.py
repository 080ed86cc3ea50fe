"""Queries over a friend graph.

``edges`` is (uid, friend), directed: ``friend`` is in the list of ``uid``. The operators expect each
edge once and no self-loops, which is what ``simple_edges`` makes of raw lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kithwork.functions import full_name
from kithwork.session import cut_lineage

from .bitmaps import DENSE, common_ids
from .skew import HotKeys, bags, copy_hot, is_small, join_splits, measure, spread_join, tag_hot

# Pairs whose shorter list has at least this many entries may be compared by bitmaps; session setting.
HUB_ROWS_SETTING = "kithwork.graph.hubRows"
HUB_ROWS_DEFAULT = 100_000


def simple_edges(edges: DataFrame) -> DataFrame:
    """Drop repeated edges and self-loops."""
    return edges.where(F.col("uid") != F.col("friend")).select("uid", "friend").distinct()


def edges_adjacency(edges: DataFrame) -> DataFrame:
    """``(uid, part, friends)``: the sorted list of every user; a giant list comes in several parts."""
    return bags(edges.select("uid", "friend"), ["uid"], F.col("friend"), "friends")


def adjacency_lines(adjacency: DataFrame) -> DataFrame:
    """``uid<TAB>f1,f2,...`` lines from lists. The parts of one user are lines of their own."""
    friends = F.array_join(F.col("friends").cast("array<string>"), ",")
    return adjacency.select(F.concat_ws("\t", F.col("uid").cast("string"), friends).alias("value"))


def mutual_friends(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(u1, u2, friend)``: the friends both users of a pair have.

    Only the shorter of the two lists is read out per pair and looked up in the longer one, so a
    pair with a hub costs what its other user costs. Where both lists are very long, and dense enough
    for it, their bitmaps are compared instead (``kithwork.graph.hubRows``).
    """
    pairs = pairs.select("u1", "u2").distinct()
    hot_u1, hot_u2 = measure(pairs, "u1", "u2")
    hot_uid, hot_friend = measure(edges, "uid", "friend")
    hot_asked = hot_u1.plus(hot_u2)
    asked = pairs.select(F.explode(F.array("u1", "u2")).alias("uid")).distinct()
    lists = spread_join(edges.select("uid", "friend"), asked, "uid", "left_semi", left_hot=hot_uid)
    sizes = lists.groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
    sized = spread_join(pairs, sizes.select(F.col("uid").alias("u1"), F.col("n").alias("n1")), "u1", left_hot=hot_u1)
    sized = spread_join(sized, sizes.select(F.col("uid").alias("u2"), F.col("n").alias("n2")), "u2", left_hot=hot_u2)
    first_is_short = F.col("n1") <= F.col("n2")
    ordered = cut_lineage(
        sized.select(
            F.when(first_is_short, F.col("u1")).otherwise(F.col("u2")).alias("uid"),
            F.when(first_is_short, F.col("u2")).otherwise(F.col("u1")).alias("other"),
            "u1",
            "u2",
            F.least("n1", "n2").alias("n"),
        )
    )
    hub_rows = _hub_rows(edges)
    row = ordered.agg(F.sum(F.when(F.col("n") < hub_rows, F.col("n"))), F.count_if(F.col("n") >= hub_rows)).first()
    if row[1]:
        hub_rows = max(hub_rows, _dense_rows(edges))
        row = ordered.agg(F.sum(F.when(F.col("n") < hub_rows, F.col("n"))), F.count_if(F.col("n") >= hub_rows)).first()
    to_look_up, hub_pairs = row[0] or 0, ordered.where(F.col("n") >= hub_rows)
    if row[1]:
        ordered = ordered.where(F.col("n") < hub_rows)
    listed = spread_join(
        edges.select("uid", "friend"), ordered.drop("n"), "uid", left_hot=hot_uid, right_hot=hot_asked
    )
    known = edges.select(F.col("uid").alias("other"), "friend")
    if is_small(edges.sparkSession, to_look_up):
        # Every edge is there once, so an inner join keeps what a semi join would.
        found = known.join(F.broadcast(listed), ["other", "friend"])
    else:
        found = _where_known(listed, known, hot_asked, hot_friend)
    found = found.select("u1", "u2", "friend")
    return found.unionByName(common_ids(edges, hub_pairs.select("u1", "u2"), hot_uid)) if row[1] else found


def _hub_rows(edges: DataFrame) -> int:
    return int(edges.sparkSession.conf.get(HUB_ROWS_SETTING, str(HUB_ROWS_DEFAULT)))


def _dense_rows(edges: DataFrame) -> int:
    """From how many entries on the bitmap of a list takes no more room than its ids."""
    low, high = edges.agg(F.min("friend"), F.max("friend")).first()
    return (high - low + 1) // DENSE


def _where_known(listed: DataFrame, known: DataFrame, hot_other: HotKeys, hot_friend: HotKeys) -> DataFrame:
    """Keep the rows of ``listed`` whose (other, friend) is an edge.

    One (other, friend) holds at most one row per list the friend is in, so it can only be hot where
    both ids are; those few combinations are split.
    """
    spark = listed.sparkSession
    others, friends = join_splits(spark, hot_other), join_splits(spark, hot_friend)
    on = ["other", "friend"]
    if others and friends:
        both = F.col("other").isin(list(others))
        listed = tag_hot(listed, "friend", friends, "_s", both)
        known = copy_hot(known, "friend", friends, "_s", both)
        on.append("_s")
    return listed.join(known, on, "left_semi")


def mutual_friends_list(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(u1, u2, part, friends)``: comma-joined; a pair without mutual friends has ``''``."""
    mutual = cut_lineage(mutual_friends(edges, pairs))
    found = bags(mutual, ["u1", "u2"], F.col("friend"), "ids")
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return _one_row_per_pair(pairs, found.select("u1", "u2", "part", text.alias("friends")), "friends")


def _one_row_per_pair(pairs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    return (
        pairs.select("u1", "u2").distinct().join(found, ["u1", "u2"], "left")
        .select("u1", "u2", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce(name, F.lit("")).alias(name))
    )


def common_friends(edges: DataFrame, ids: DataFrame, min_lists: int = 2) -> DataFrame:
    """``(friend, n)``: friends found in at least ``min_lists`` of the lists of the users ``ids(uid)``."""
    lists = spread_join(edges.select("uid", "friend"), ids.select("uid").distinct(), "uid", "left_semi")
    return lists.groupBy("friend").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_lists)


def mutual_friend_profiles(edges: DataFrame, profiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(u1, u2, friend, name, zip)``: mutual friends that have a profile."""
    details = profiles.select(
        F.col("uid").alias("friend"), full_name(F.col("first_name"), F.col("last_name")).alias("name"), "zip"
    )
    mutual = cut_lineage(mutual_friends(edges, pairs))
    return spread_join(mutual, details, "friend").select("u1", "u2", "friend", "name", "zip")


def mutual_friend_profiles_list(edges: DataFrame, profiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(u1, u2, part, profiles)``: ``name:zip`` items in friend order, only pairs that have any."""
    rows = cut_lineage(mutual_friend_profiles(edges, profiles, pairs))
    item = F.struct("friend", F.concat_ws(":", "name", "zip").alias("text"))
    found = bags(rows, ["u1", "u2"], item, "items")
    return found.select("u1", "u2", "part", F.array_join("items.text", ",").alias("profiles"))


def friend_candidates(edges: DataFrame, targets: DataFrame, hot: list[HotKeys] | None = None) -> DataFrame:
    """``(target, candidate, n)``: everyone who shares ``n`` listing users with a target, but no friend of it.

    The two steps of a path run target <- via -> candidate: users that list the target, then everyone
    in their lists. The work is the lists of the users next to the targets. ``hot`` are the hot users and
    friends of ``edges`` where they are measured already.
    """
    targets = targets.select("target").distinct()
    hot_uid, hot_friend = hot or measure(edges, "uid", "friend")
    incoming = edges.select(F.col("friend").alias("target"), F.col("uid").alias("via"))
    first = cut_lineage(spread_join(incoming, targets, "target", "left_semi", left_hot=hot_friend))
    hot_via = measure(first, "via")[0]
    second = edges.select(F.col("uid").alias("via"), F.col("friend").alias("candidate"))
    paths = spread_join(second, first, "via", left_hot=hot_uid, right_hot=hot_via)
    paths = paths.where(F.col("candidate") != F.col("target"))
    counted = paths.groupBy("target", "candidate").agg(F.count(F.lit(1)).alias("n"))
    own = spread_join(
        edges.select(F.col("uid").alias("target"), F.col("friend").alias("candidate")),
        targets, "target", "left_semi", left_hot=hot_uid,
    )
    return counted.join(own, ["target", "candidate"], "left_anti")


def recommend_friends(edges: DataFrame, targets: DataFrame, k: int = 10, hot: list[HotKeys] | None = None) -> DataFrame:
    """``(target, rank, candidate, n)``: the ``k`` best candidates, most shared users first, then lower id.

    Every task keeps its own best ``k`` per target before the shuffle.
    """
    order = Window.partitionBy("target").orderBy(F.desc("n"), F.asc("candidate"))
    ranked = friend_candidates(edges, targets, hot).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("target", "rank", "candidate", "n")


def recommendation_list(edges: DataFrame, targets: DataFrame, k: int = 10) -> DataFrame:
    """``(target, candidates)``: comma-joined in rank order; ``''`` for a target whose lists give none.

    A target that appears in no edge has no row.
    """
    hot = measure(edges, "uid", "friend")
    best = recommend_friends(edges, targets, k, hot)
    items = F.sort_array(F.collect_list(F.struct("rank", F.col("candidate").cast("string").alias("id"))))
    lists = best.groupBy("target").agg(F.array_join(items["id"], ",").alias("candidates"))
    return _known_targets(edges, targets, hot).join(lists, "target", "left").select(
        "target", F.coalesce("candidates", F.lit("")).alias("candidates")
    )


def candidate_list(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """``(target, part, candidates)``: every candidate of a target, comma-joined in id order."""
    hot = measure(edges, "uid", "friend")
    candidates = cut_lineage(friend_candidates(edges, targets, hot).select("target", "candidate"))
    found = bags(candidates, ["target"], F.col("candidate"), "ids")
    lists = found.select("target", "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("candidates"))
    return _known_targets(edges, targets, hot).join(lists, "target", "left").select(
        "target", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("candidates", F.lit("")).alias("candidates")
    )


def _known_targets(edges: DataFrame, targets: DataFrame, hot: list[HotKeys]) -> DataFrame:
    """The targets that have a list of their own or stand in somebody's list."""
    targets = targets.select("target").distinct()
    hot_uid, hot_friend = hot
    owners = edges.select(F.col("uid").alias("target"), F.col("friend").alias("by"))
    listed = edges.select(F.col("friend").alias("target"), F.col("uid").alias("by"))
    owners = spread_join(owners, targets, "target", "left_semi", left_hot=hot_uid)
    listed = spread_join(listed, targets, "target", "left_semi", left_hot=hot_friend)
    return owners.union(listed).select("target").distinct()
