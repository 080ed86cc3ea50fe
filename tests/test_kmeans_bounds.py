"""KMeans on items that change clusters for many iterations: equal to numpy, and fewer and fewer are measured."""

import numpy as np
import pytest

from kithwork.operators import clustering as cl


def numpy_kmeans(points, k, iterations, seed=11):
    modulus, multiplier = 2147483647, 742938285
    items = sorted(points)
    x = np.array([points[i] for i in items])
    order = sorted(range(len(items)), key=lambda n: ((items[n] * multiplier + seed) % modulus, items[n]))[:k]
    cluster = np.full(len(items), -1)
    cluster[order] = range(len(order))
    centres = None
    for _ in range(iterations):
        new = np.array([x[cluster == j].mean(axis=0) if (cluster == j).any() else centres[j] for j in range(len(order))])
        centres = new
        d = np.round((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), cl.DIGITS)
        cluster = d.argmin(axis=1)
    return {i: (int(c), max(0.0, float(row[c]))) for i, c, row in zip(items, cluster, d)}


def line_of_items(n=240, users=12):
    """Items along a bent line: clusters creep along it for many iterations."""
    t = np.linspace(0, 6, n)
    values = np.stack([np.round(3 + 2 * np.sin(t * (1 + u / 7) + u), 3) for u in range(users)], axis=1)
    # A user has not rated every item; what is missing counts as 0.
    return {i + 1: [float(v) if (i + u) % 5 else 0.0 for u, v in enumerate(row)] for i, row in enumerate(values)}


@pytest.mark.parametrize("k,iterations", [(4, 10), (1, 3)])
def test_equal_to_numpy_while_items_move(spark, monkeypatch, k, iterations):
    points = line_of_items()
    rows = [(u, i, v) for i, vs in points.items() for u, v in enumerate(vs) if v]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double").repartition(3)
    active, bounds = [], cl._with_bounds

    def counted(assigned, shifts):
        found = bounds(assigned, shifts)
        active.append(found[1])
        return found

    monkeypatch.setattr(cl, "_with_bounds", counted)
    found = {r.item_id: (r.cluster, r.sq_dist) for r in cl.kmeans_items(df, k=k, iterations=iterations).collect()}
    expected = numpy_kmeans(points, k, iterations)
    assert {i: c for i, (c, _) in found.items()} == {i: c for i, (c, _) in expected.items()}
    assert all(abs(found[i][1] - d) < 1e-6 for i, (_, d) in expected.items())
    if k > 1:
        assert len(active) > 1 and min(active) < len(points) / 2


def test_no_ratings(spark):
    df = spark.createDataFrame([], "user_id bigint, item_id bigint, rating double")
    assert cl.kmeans_items(df, k=3, iterations=2).count() == 0
