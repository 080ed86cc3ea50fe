"""Decision trees grown level by level from histograms, kept as a table of nodes.

Every feature is cut into at most ``MAX_BINS`` bins at values of its own distribution. One aggregation per level
counts (node, feature, bin, class), partly in every task, so a level shuffles at most nodes x features x bins x
classes counts per task, however many rows there are. All splits of the level are rated from these counts with
windows of one class or one feature of a node. The class counts, whatever their number, never leave the cluster.

A node is a row (node, depth, n, label, feature, threshold): the root is 1, the children of i are 2i and 2i + 1,
leaves have a null feature. A row goes to the first child if its feature is not above the threshold; a value that
is missing or not a number goes to the second. A table has at most 2^(depth + 1) rows, so it is broadcast.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kithwork.session import cut_lineage

from .ordering import running_counts

# Fixed values of the original job: depth and bins.
MAX_DEPTH = 5
MAX_BINS = 32
# A split must raise the rating (rows minus weighted impurity) by more than rounding errors could.
LEAST_GAIN = 1e-9
# Node numbers are 64-bit and a level is broadcast.
DEPTH_LIMIT = 16
NODES = "node long, depth int, n long, label double, feature int, threshold double"


class Tree(NamedTuple):
    nodes: DataFrame
    depth: int  # levels below the root


def thresholds(rows: DataFrame, bins: int = MAX_BINS) -> DataFrame:
    """``(feature, at, threshold)``: the cuts of every feature in ascending order, numbered from 0.

    A feature of at most ``bins`` values is cut after each of them, any other where its running count first
    reaches a multiple of 1/``bins`` of the rows. No cut follows the largest value.
    """
    values = rows.select(F.posexplode("features").alias("feature", "threshold"))
    counts = running_counts(values.where("threshold is not null and not isnan(threshold)"), "feature", "threshold")
    crosses = F.expr(f"upto * {bins} div total > (upto - n) * {bins} div total")
    cuts = counts.where((F.col("upto") < F.col("total")) & ((F.col("distinct") <= bins) | crosses))
    order = Window.partitionBy("feature").orderBy("threshold")  # at most ``bins`` rows
    return cuts.select("feature", (F.row_number().over(order) - 1).alias("at"), "threshold")


def _binned(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``(label, bins)``: bin b of a feature has b cuts below the value; bin 0 of place 0 holds for all rows."""
    lists = cuts.groupBy("feature").agg(F.sort_array(F.collect_list("threshold")).alias("cuts"))
    # One row: features x bins numbers, as many as some rows of the input hold.
    known = lists.agg(F.map_from_entries(F.collect_list(F.struct("feature", "cuts"))).alias("known"))
    bins = F.transform("features", lambda x, j: _bin(x, F.coalesce(F.try_element_at("known", j), F.array().cast("array<double>"))))
    return rows.withColumn("known", known.scalar()).select("label", F.array_insert(bins, 1, F.lit(0)).alias("bins"))


def _bin(x: Column, cuts: Column) -> Column:
    value = F.coalesce(x, F.lit(float("nan")))  # not a number sorts last
    return F.size(F.filter(cuts, lambda cut: cut < value))


def _descend(binned: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The rows that have not come to a leaf, with their node."""
    rows = binned.withColumn("node", F.lit(1).cast("long"))
    for splits in levels:
        rows = rows.join(F.broadcast(splits.select("node", "feature", "at")), "node")
        right = (F.get("bins", F.col("feature") + 1) > F.col("at")).cast("long")
        rows = rows.select("label", "bins", (F.col("node") * 2 + right).alias("node"))
    return rows


def _summaries(totals: DataFrame, depth: int) -> DataFrame:
    """``(node, depth, n, label, squares)`` from class counts: a node's label is the most frequent, then lowest one."""
    first = F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"]
    squares = F.sum(F.col("n").cast("double") * F.col("n"))
    return totals.groupBy("node").agg(F.lit(depth).alias("depth"), F.sum("n").alias("n"), first.alias("label"), squares.alias("squares"))


def _best_splits(histogram: DataFrame, totals: DataFrame, nodes: DataFrame, least_rows: int) -> DataFrame:
    """``(node, feature, at)`` of the nodes that gain by a split; ties go to the lowest feature, then cut.

    The rating of a split is the sum over both sides of the squared class counts over the rows. Moving the n
    rows of a class in a bin to the first side changes its square from l^2 to (l + n)^2, and the other's alike.
    """
    whole = totals.withColumnRenamed("n", "class_rows")
    classes = Window.partitionBy("node", "feature", "label").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cells = histogram.join(whole, ["node", "label"])
    n, l = F.col("n").cast("double"), F.coalesce(F.sum("n").over(classes), F.lit(0)).cast("double")
    cells = cells.select("node", "feature", "bin", "n", (n * (l * 2 + n)).alias("more"), (n * ((F.col("class_rows") - l) * 2 - n)).alias("less"))
    bins = cells.groupBy("node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("more").alias("more"), F.sum("less").alias("less"))
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = bins.join(nodes.select("node", F.col("n").alias("all"), "squares"), "node").select(
        "node", "feature", "bin", "all", "squares", F.sum("n").over(upto).alias("left"),
        F.sum("more").over(upto).alias("left_squares"), (F.col("squares") - F.sum("less").over(upto)).alias("right_squares"),
    )
    sides = sides.where((F.col("left") >= least_rows) & (F.col("all") - F.col("left") >= least_rows))
    rating = F.col("left_squares") / F.col("left") + F.col("right_squares") / (F.col("all") - F.col("left"))
    gains = sides.withColumn("rating", rating).where(F.col("rating") - F.col("squares") / F.col("all") > LEAST_GAIN)
    best = F.min(F.struct((-F.col("rating")).alias("r"), "feature", "bin"))
    return gains.groupBy("node").agg(best.alias("b")).select("node", F.col("b.feature").alias("feature"), F.col("b.bin").alias("at"))


def fit_tree(train: DataFrame, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS, least_rows: int = 1) -> Tree:
    """Fit by Gini impurity on rows ``(label, features)``; all rows have the same number of features.

    ``least_rows`` is the smallest size of a node. Rows without label or features are left out.
    """
    if not 0 <= max_depth <= DEPTH_LIMIT:
        raise ValueError(f"max_depth must be between 0 and {DEPTH_LIMIT}")
    rows = train.where("label is not null and features is not null").select("label", "features")
    cuts = cut_lineage(thresholds(rows, max_bins))
    binned = cut_lineage(_binned(rows, cuts))
    levels, summaries = [], []
    for depth in range(max_depth + 1):
        here = _descend(binned, levels)
        if depth < max_depth:
            cells = here.select("node", "label", F.posexplode("bins").alias("place", "bin"))
            cells = cut_lineage(cells.groupBy("node", "place", "bin", "label").agg(F.count(F.lit(1)).alias("n")))
            totals = cells.where("place = 0").select("node", "label", "n")
        else:
            totals = here.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
        nodes = cut_lineage(_summaries(totals, depth))
        summaries.append(nodes.drop("squares"))
        if depth == max_depth:
            break
        histogram = cells.where("place > 0").withColumn("feature", F.col("place") - 1).drop("place")
        splits = cut_lineage(_best_splits(histogram, totals, nodes, least_rows))
        if splits.isEmpty():
            break
        levels.append(splits)
    nodes = summaries[0]
    for more in summaries[1:]:
        nodes = nodes.unionByName(more)
    if not levels:
        return Tree(nodes.select("*", F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold")), 0)
    splits = levels[0]
    for more in levels[1:]:
        splits = splits.unionByName(more)
    # A level has at most 2^depth splits, and as many cuts are looked up.
    splits = cuts.join(F.broadcast(splits), ["feature", "at"]).select("node", "feature", "threshold")
    return Tree(cut_lineage(nodes.join(splits, "node", "left")), len(levels))


def predict_tree(tree: Tree, rows: DataFrame) -> DataFrame:
    """``(id, label, prediction)``; a row walks one level per join with the broadcast inner nodes of the level."""
    inner = F.broadcast(tree.nodes.where("feature is not null").select("node", "feature", "threshold"))
    found = rows.select("id", "label", "features").withColumn("node", F.lit(1).cast("long"))
    for _ in range(tree.depth):
        found = found.join(inner, "node", "left")
        value = F.coalesce(F.get("features", "feature"), F.lit(float("nan")))
        child = F.col("node") * 2 + (value > F.col("threshold")).cast("long")
        found = found.select("id", "label", "features", F.coalesce(child, F.col("node")).alias("node"))
    labels = F.broadcast(tree.nodes.select("node", F.col("label").alias("prediction")))
    return found.join(labels, "node", "left").select("id", "label", "prediction")


def tree_text(tree: Tree) -> DataFrame:
    """``(n, line)``: the tree as indented If, Else and Predict lines, numbered from 0, after a line with its size.

    The lines are ordered in one task: there are at most 2^(depth + 1) nodes.
    """
    nodes = tree.nodes.withColumn("path", F.substring(F.conv(F.col("node").cast("string"), 10, 2), 2, 64))
    size = nodes.agg(F.max("depth").alias("d"), F.count(F.lit(1)).alias("c"))
    head = size.select(F.lit("").alias("path"), F.lit(-1).alias("kind"), F.concat(F.lit("DecisionTreeModel classifier of depth "), "d", F.lit(" with "), "c", F.lit(" nodes")).alias("line"))
    indent = F.repeat(F.lit(" "), F.col("depth") + 2)
    inner, leaves = nodes.where("feature is not null"), nodes.where("feature is null")

    def branch(word: str, sign: str, path: Column, kind: int) -> DataFrame:
        text = F.concat(F.lit(f"{word} (feature "), F.col("feature").cast("string"), F.lit(f" {sign} "), F.col("threshold").cast("string"), F.lit(")"))
        return inner.select(path.alias("path"), F.lit(kind).alias("kind"), F.concat(indent, text).alias("line"))

    # A branch line stands right before the lines of its child: 0 for "If" at the path itself, 1 for "Else".
    lines = head.unionByName(branch("If", "<=", F.col("path"), 2)).unionByName(branch("Else", ">", F.concat("path", F.lit("1")), 0))
    predict = F.concat(indent, F.lit("Predict: "), F.col("label").cast("string"))
    lines = lines.unionByName(leaves.select("path", F.lit(2).alias("kind"), predict.alias("line")))
    return lines.select((F.row_number().over(Window.orderBy("path", "kind")) - 1).alias("n"), "line")


def save_tree(tree: Tree, path: str) -> None:
    """The table of nodes as one small file; an older one is replaced."""
    tree.nodes.coalesce(1).write.mode("overwrite").parquet(path)


def load_tree(spark: SparkSession, path: str) -> Tree:
    nodes = spark.read.schema(NODES).parquet(path)
    return Tree(nodes, nodes.agg(F.max("depth")).first()[0] or 0)
