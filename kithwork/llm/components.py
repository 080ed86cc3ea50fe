"""Connected components of an edge table, as rounds of large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kithwork.llm.tables import few_tasks, stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int | None = None) -> DataFrame:
    """(id, component): for every linked id the smallest id reachable, itself included.

    Null ids and loops link nothing; repeated edges count once. Each round links every node to the
    smallest id in sight, so a star is done in one round and a path in about log2 of its length; the rounds
    end as soon as there are only stars. Only counts of the edges reach the driver, and few edges are few
    tasks. ``most`` is an upper bound of the number of edges, if one is known.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    links = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = links.select(high.alias("u"), low.alias("v")).distinct()
    links = stored(links if most is None else few_tasks(links, most), "edges")
    # No round makes more links than there were.
    rows = links.count()
    while _unfinished(links, rows):
        links = stored(few_tasks(_small_star(_large_star(links, rows), rows), rows), "edges")
        rows = links.count()
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _unfinished(links: DataFrame, rows: int) -> int:
    """How many nodes are linked to a smaller one and to any other: none where the links are stars around their smallest nodes."""
    ends = links.select(F.explode(F.array(*(F.struct(F.col(c).alias("x"), F.lit(up).alias("up")) for c, up in (("u", 1), ("v", 0))))).alias("end"))
    nodes = ends.groupBy("end.x").agg(F.sum("end.up").alias("ups"), F.count("*").alias("n"))
    return few_tasks(nodes, 2 * rows).where("ups > 0 and n > 1").count()


def _large_star(links: DataFrame, rows: int) -> DataFrame:
    """Link the larger neighbours of every node to the smallest of its neighbourhood; links may repeat."""
    both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(links.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = few_tasks(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), 2 * rows)
    larger = both.where(F.col("y") > F.col("x"))
    return few_tasks(larger.join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")), rows)


def _small_star(links: DataFrame, rows: int) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them."""
    least = few_tasks(links.groupBy("u").agg(F.min("v").alias("m")), rows)
    moved = few_tasks(links.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")), rows)
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
