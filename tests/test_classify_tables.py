"""Tree and Naive Bayes tables: against brute force, with awkward values and many classes."""

import math
import random

import numpy as np
import pytest

from kithwork.operators import bayes as nb, classify as cf, tree as dt
from kithwork.operators.ordering import numbered, running_counts

SCHEMA = "id bigint, label double, features array<double>"


def sample(spark, n, width, classes, values, seed=3):
    r = random.Random(seed)
    rows = [(i, float(r.randrange(classes)), [float(r.choice(values)) for _ in range(width)]) for i in range(n)]
    rows = [(i, y, [x + 3 * (y == j) for j, x in enumerate(xs)]) for i, y, xs in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(5), rows


def brute_cuts(column, bins):
    column = sorted(column)
    n, kinds = len(column), sorted(set(column))
    if len(kinds) <= bins:
        return kinds[:-1]
    ranks = {v: sum(x <= v for x in column) for v in kinds}
    return sorted({next(v for v in kinds if ranks[v] * bins >= b * n) for b in range(1, bins)} - {kinds[-1]})


def brute_tree(rows, depth, bins, least=1):
    """node -> (n, label, feature, threshold)"""
    cuts = [brute_cuts([xs[j] for _, _, xs in rows], bins) for j in range(len(rows[0][2]))]
    out, todo = {}, [(1, 0, rows)]

    def squares(part):
        counts = {}
        for _, y, _ in part:
            counts[y] = counts.get(y, 0) + 1
        return sum(c * c for c in counts.values()) / len(part), min(counts, key=lambda y: (-counts[y], y))

    while todo:
        node, at, part = todo.pop()
        purity, label = squares(part)
        best = None
        for j, own in enumerate(cuts if at < depth else []):
            for t in own:
                left, right = [r for r in part if r[2][j] <= t], [r for r in part if not r[2][j] <= t]
                if len(left) < least or len(right) < least:
                    continue
                rating = squares(left)[0] + squares(right)[0]
                if rating - purity > 1e-9 and (best is None or rating > best[0]):
                    best = rating, j, t, left, right
        out[node] = (len(part), label, *(best[1:3] if best else (None, None)))
        if best:
            todo += [(2 * node, at + 1, best[3]), (2 * node + 1, at + 1, best[4])]
    return out


@pytest.mark.parametrize("n,width,classes,values,depth,bins,least", [
    (200, 3, 3, range(6), 3, 32, 1), (300, 2, 2, [k / 7 for k in range(100)], 4, 5, 1), (150, 4, 5, range(3), 2, 2, 10), (60, 1, 1, [1], 5, 32, 1), (40, 2, 4, range(50), 0, 8, 1),
])
def test_tree_equals_brute_force(spark, n, width, classes, values, depth, bins, least):
    df, rows = sample(spark, n, width, classes, list(values))
    found = dt.fit_tree(df, depth, bins, least)
    nodes = {r.node: (r.n, r.label, r.feature, r.threshold) for r in found.nodes.collect()}
    assert nodes == brute_tree(rows, depth, bins, least)
    walked = {r.id: r.prediction for r in dt.predict_tree(found, df).collect()}
    for i, _, xs in rows:
        node = 1
        while nodes[node][2] is not None:
            node = 2 * node + (xs[nodes[node][2]] > nodes[node][3])
        assert walked[i] == nodes[node][1]


def test_tree_takes_missing_values_null_labels_and_no_rows(spark):
    nan = float("nan")
    rows = [(1, 0.0, [1.0, None]), (2, 0.0, [2.0, nan]), (3, 1.0, [nan, 3.0]), (4, 1.0, [None, 4.0]), (5, None, [1.0, 1.0]), (6, 1.0, None)]
    found = dt.fit_tree(spark.createDataFrame(rows, SCHEMA))
    assert {(r.node, r.n, r.feature, r.threshold) for r in found.nodes.collect()} >= {(1, 4, 0, 1.0)}
    walked = {r.id: r.prediction for r in dt.predict_tree(found, spark.createDataFrame(rows, SCHEMA)).collect()}
    # Rows 2 and 4 come to the same leaf, one of each class: the lower label.
    assert (walked[1], walked[3], walked[2], walked[4]) == (0.0, 1.0, 0.0, 0.0) and len(walked) == 6
    empty = dt.fit_tree(spark.createDataFrame([], SCHEMA))
    assert empty.nodes.count() == 0 and empty.depth == 0
    assert [r.prediction for r in dt.predict_tree(empty, spark.createDataFrame(rows[:1], SCHEMA)).collect()] == [None]


def test_tree_text_and_saving(spark, tmp_path):
    rows = [(k, float(k > 4), [float(k), 0.0]) for k in range(10)]
    found = dt.fit_tree(spark.createDataFrame(rows, SCHEMA))
    lines = ["DecisionTreeModel classifier of depth 1 with 3 nodes", "  If (feature 0 <= 4.0)", "   Predict: 0.0", "  Else (feature 0 > 4.0)", "   Predict: 1.0"]
    assert [r.line for r in dt.tree_text(found).orderBy("n").collect()] == lines
    for _ in range(2):
        dt.save_tree(found, str(tmp_path / "t"))
    loaded = dt.load_tree(spark, str(tmp_path / "t"))
    assert loaded.depth == 1 and sorted(loaded.nodes.collect()) == sorted(found.nodes.collect())
    with pytest.raises(ValueError):
        dt.fit_tree(loaded.nodes, max_depth=40)


def test_tree_level_is_aggregated_before_its_shuffle(spark):
    df, _ = sample(spark, 100, 3, 2, list(range(5)))
    rows = df.select("label", "features")
    text = dt._binned(rows, dt.thresholds(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def brute_bayes(rows, train, smoothing):
    labels = sorted({y for i, y, _ in rows if i in train})
    prior, terms = {}, {}
    for c in labels:
        mine = [x for i, y, x in rows if y == c and i in train]
        prior[c] = math.log(len(mine) + smoothing) - math.log(len(train) + smoothing * len(labels))
        sums = np.sum(mine, axis=0)
        terms[c] = np.log(sums + smoothing) - math.log(sums.sum() + smoothing * len(sums))
    return {i: max(labels, key=lambda c: (round(prior[c] + np.dot(x, terms[c]), 9), -c)) for i, _, x in rows}


@pytest.mark.parametrize("smoothing", [1.0, 0.25])
def test_bayes_equals_the_closed_form_with_and_without_broadcast(large, smoothing):
    df, rows = sample(large, 200, 5, 4, [0, 0, 1, 2])
    model = nb.fit_bayes(df.where("id < 120"), smoothing)
    found = {r.id: r.prediction for r in nb.predict_bayes(model, df).collect()}
    assert found == brute_bayes(rows, set(range(120)), smoothing)


def test_bayes_saving_and_awkward_rows(spark, tmp_path):
    rows = [(1, 0.0, [1.0, 0.0]), (2, 1.0, [0.0, 2.0]), (3, None, [5.0, 0.0]), (4, 1.0, None), (5, 2.0, [0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    for _ in range(2):
        nb.save_bayes(nb.fit_bayes(df), str(tmp_path / "b"))
    found = {r.id: r.prediction for r in nb.predict_bayes(nb.load_bayes(spark, str(tmp_path / "b")), df).collect()}
    assert found == {1: 0.0, 2: 1.0, 3: 0.0, 4: None, 5: 0.0}
    with pytest.raises(Exception, match="negative"):
        nb.fit_bayes(spark.createDataFrame([(1, 0.0, [-1.0])], SCHEMA)).weights.collect()
    with pytest.raises(ValueError):
        nb.fit_bayes(df, 0)


def test_a_hundred_thousand_classes(spark):
    """Class c has its rows at feature c % 50 and length c; the asked rows are rows of the training part."""
    df = spark.range(100_000).selectExpr("id", "cast(id as double) label", "transform(sequence(0, 49), j -> if(j = id % 50, double(id + 1), 0D)) features")
    model = nb.fit_bayes(df)
    asked = df.where("id in (0, 77, 49999, 99950, 99999)")
    found = {r.id: r.prediction for r in nb.predict_bayes(model, asked).collect()}
    # The longest class of a feature explains a long row best; a short row says little about its class.
    assert found.keys() == {0, 77, 49999, 99950, 99999} and all(int(p) % 50 == i % 50 for i, p in found.items() if i > 1000)
    tree = dt.fit_tree(df.where("id < 2000"), max_depth=1)
    assert tree.nodes.count() == 3


def test_numbers_and_running_counts_follow_the_order(spark):
    r = random.Random(1)
    keys = [r.randrange(50) for _ in range(500)]
    df = spark.createDataFrame([(k, str(i)) for i, k in enumerate(keys)], "k bigint, v string").repartition(7)
    found = sorted((x.n, x.k) for x in numbered(df, "k", "n").collect())
    assert [n for n, _ in found] == list(range(500)) and [k for _, k in found] == sorted(keys)
    counts = running_counts(df.selectExpr("k % 3 g", "k"), "g", "k").collect()
    for x in counts:
        own = [k for k in keys if k % 3 == x.g]
        assert (x.n, x.upto, x.total, x.distinct) == (own.count(x.k), sum(k <= x.k for k in own), len(own), len(set(own)))
    assert numbered(df.where("false"), "k", "n").count() == 0


def test_jobs_use_the_tables(spark):
    df, _ = sample(spark, 300, 4, 3, list(range(4)))
    for method in (cf.decision_tree, cf.naive_bayes, cf.decision_tree_mllib, cf.naive_bayes_mllib):
        assert cf.accuracy(method(df)).first().accuracy > 0.6
