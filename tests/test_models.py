import math
import random

import numpy as np
import pytest

from kithwork.operators import classify as cf, clustering as cl, factorize as fz
from kithwork.session import id_frame


@pytest.fixture(scope="module")
def rating_rows():
    """User 1 rated nearly everything and item 2 was rated by nearly everyone."""
    rng = random.Random(9)
    rows = {(1, i): rng.randint(1, 5) for i in range(1, 60)}
    rows |= {(u, 2): rng.randint(1, 5) for u in range(1, 50)}
    rows |= {(rng.randrange(1, 50), rng.randrange(1, 60)): rng.randint(1, 5) for _ in range(160)}
    return [(u, i, r) for (u, i), r in rows.items()]


def rated(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating int").repartition(3)


def start(users, k, seed=7):
    modulus, multiplier = 2147483647, 742938285
    return {u: np.array([((u % modulus) * pow(multiplier, s + 1, modulus) + seed) % modulus / modulus for s in range(k)]) for u in users}


def numpy_als(rows, k, rounds, users):
    items = {}
    for _ in range(rounds):
        for side, source, target in (("i", users, items), ("u", items, users)):
            sums = {}
            for u, i, r in rows:
                a, b = (u, i) if side == "i" else (i, u)
                m, v = sums.setdefault(b, (np.eye(k), np.zeros(k)))
                f = source[a]
                sums[b] = (m + np.outer(f, f), v + r * f)
            target.clear()
            target.update({key: np.linalg.solve(m, v) for key, (m, v) in sums.items()})
    return users, items


def close(frame, key, expected):
    found = {r[key]: r.factors for r in frame.collect()}
    assert found.keys() == expected.keys()
    for name, vector in expected.items():
        assert found[name] == pytest.approx(list(vector), abs=1e-8)


@pytest.mark.parametrize("k, rounds", [(5, 3), (2, 2), (9, 2)])
def test_als_equals_a_numpy_solve_with_hot_keys(spark, skewed, rating_rows, k, rounds):
    users, items = fz.als_factors(rated(spark, rating_rows), k=k, rounds=rounds)
    expected = numpy_als(rating_rows, k, rounds, start({u for u, _, _ in rating_rows}, k))
    close(users, "user_id", expected[0])
    close(items, "item_id", expected[1])


def test_als_constant_start_follows_the_scalar_rule(spark, rating_rows):
    users, items = fz.als_factors(rated(spark, rating_rows), rounds=1, init="constant")
    by_item = {}
    for u, i, r in rating_rows:
        s, n = by_item.get(i, (0, 0))
        by_item[i] = (s + r * 0.5, n + 1)
    scalar = {i: s / (1 + 5 * n * 0.25) for i, (s, n) in by_item.items()}
    close(items, "item_id", {i: [f] * 5 for i, f in scalar.items()})


def test_als_loss_does_not_grow(spark, rating_rows):
    df = rated(spark, rating_rows)
    losses = [fz.als_loss(df, *fz.als_factors(df, rounds=n)).first().loss for n in (1, 2, 4)]
    assert losses[0] >= losses[1] >= losses[2]


def test_als_predicts_pairs_and_leaves_out_unknown_ids(spark, rating_rows):
    df = rated(spark, rating_rows)
    users, items = fz.als_factors(df, rounds=2)
    found = fz.als_predict(id_frame(spark, user_id=[1, 1, 999], item_id=[2, 3, 2]), users, items).collect()
    u = {r.user_id: np.array(r.factors) for r in users.collect()}
    v = {r.item_id: np.array(r.factors) for r in items.collect()}
    assert {(r.user_id, r.item_id): pytest.approx(r.score) for r in found} == {(1, 2): u[1] @ v[2], (1, 3): u[1] @ v[3]}


def numpy_kmeans(rows, k, iterations, seed=11):
    items = sorted({i for _, i, _ in rows})
    width = max(u for u, _, _ in rows) + 1
    x = np.zeros((len(items), width))
    for u, i, r in rows:
        x[items.index(i), u] = r
    order = sorted(range(len(items)), key=lambda n: ((items[n] * 742938285 + seed) % 2147483647, items[n]))
    centres = x[order[:k]].copy()
    for _ in range(iterations):
        distances = np.round(((x[:, None, :] - centres[None]) ** 2).sum(axis=2), 9)
        nearest = distances.argmin(axis=1)
        result = {item: (int(c), float(d[c])) for item, c, d in zip(items, nearest, distances)}
        for j in range(k):
            if (nearest == j).any():
                centres[j] = x[nearest == j].mean(axis=0)
    return result


@pytest.mark.parametrize("k", [4, 25])
def test_kmeans_equals_a_dense_computation_with_hot_keys(spark, skewed, rating_rows, k):
    found = {r.item_id: (r.cluster, r.sq_dist) for r in cl.kmeans_items(rated(spark, rating_rows), k=k, iterations=4).collect()}
    expected = numpy_kmeans(rating_rows, k, 4)
    assert {i: c for i, (c, _) in found.items()} == {i: c for i, (c, _) in expected.items()}
    assert all(found[i][1] == pytest.approx(d, abs=1e-6) for i, (_, d) in expected.items())


def test_kmeans_with_more_clusters_than_items(spark):
    rows = [(1, 1, 5), (2, 2, 3), (2, 2, 5)]
    found = {r.item_id: r.sq_dist for r in cl.kmeans_items(rated(spark, rows), k=10, iterations=2).collect()}
    assert found == {1: 0.0, 2: 0.0}


def test_samples_per_cluster(spark):
    assigned = spark.createDataFrame([(i, i % 2, 0.0) for i in range(20)] + [(99, 2, 0.0)], "item_id bigint, cluster int, sq_dist double")
    movies = spark.createDataFrame([(i, f"t{i}", "g") for i in range(100)], "item_id bigint, title string, genres string")
    found = sorted(tuple(r)[:2] for r in cl.cluster_samples(assigned, movies).collect())
    assert found == [(0, i) for i in range(0, 10, 2)] + [(1, i) for i in range(1, 10, 2)] + [(2, 99)]


def test_item_vectors_average_repeats_and_split_long_ones(spark, skewed, rating_rows):
    rows = rating_rows + [(1, 2, 5), (1, 2, 3)]
    values = {}
    for u, i, r in rows:
        values.setdefault((i, u - 1), []).append(r)
    found, longest = {}, 0
    for r in cl.item_vectors(rated(spark, rows)).collect():
        assert r.size == max(u for u, _, _ in rows) and list(r.indices) == sorted(r.indices)
        longest = max(longest, len(r.indices))
        found |= {(r.item_id, i): x for i, x in zip(r.indices, r["values"])}
    assert found == {key: sum(v) / len(v) for key, v in values.items()}
    assert longest < 40


def test_library_kmeans_on_whole_vectors_and_in_parts(spark, rating_rows, skewed):
    vectors = cl.item_vectors(rated(spark, rating_rows))
    assert vectors.where("part > 0").count() > 0
    found = cl.kmeans_mllib(vectors, k=3, iterations=2).collect()
    assert sorted(r.item_id for r in found) == sorted({i for _, i, _ in rating_rows})
    assert {r.cluster for r in found} <= {0, 1, 2}


def test_item_vectors_take_wide_ids(spark):
    row = cl.item_vectors(rated(spark, [(5_000_000_001, 1, 4), (1, 1, 2)])).first()
    assert (list(row.indices), row.size) == ([0, 5_000_000_000], 5_000_000_001)


def labelled(spark, n=300, classes=(1.0, 7.0, 3.0)):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        c = i % len(classes)
        rows.append((i, classes[c], [float(rng.randint(0, 3) + 6 * (j == c)) for j in range(4)]))
    return spark.createDataFrame(rows, "id bigint, label double, features array<double>"), rows


def test_split_is_stable_and_near_its_share(spark):
    df, rows = labelled(spark, 1000)
    train, test = cf.split_by_id(df)
    ids = sorted(r.id for r in train.collect())
    assert sorted(r.id for r in cf.split_by_id(df.repartition(7))[0].collect()) == ids
    assert 550 < len(ids) < 650 and len(ids) + test.count() == 1000


def test_naive_bayes_predicts_label_values_by_the_closed_form(spark):
    df, rows = labelled(spark)
    train, _ = cf.split_by_id(df)
    train_ids = {r.id for r in train.collect()}
    labels = sorted({y for _, y, _ in rows})
    prior, terms = {}, {}
    for c in labels:
        mine = [x for i, y, x in rows if y == c and i in train_ids]
        prior[c] = math.log(len(mine) + 1) - math.log(len(train_ids) + len(labels))
        sums = np.sum(mine, axis=0)
        terms[c] = np.log(sums + 1) - math.log(sums.sum() + len(sums))
    expected = {i: max(labels, key=lambda c: (prior[c] + np.dot(x, terms[c]), -c)) for i, _, x in rows if i not in train_ids}
    predictions = cf.naive_bayes(df)
    assert {r.id: r.prediction for r in predictions.collect()} == expected
    row = cf.accuracy(predictions).first()
    assert row.n == len(expected) and 0.9 < row.accuracy <= 1.0


def test_decision_tree_predicts_label_values(spark):
    df, _ = labelled(spark)
    predictions = cf.decision_tree(df)
    assert {r.prediction for r in predictions.collect()} <= {1.0, 3.0, 7.0}
    assert cf.accuracy(predictions).first().accuracy > 0.9


def test_models_survive_saving(spark, tmp_path):
    df, _ = labelled(spark)
    classes = cf.class_values(df)
    for fit, load, name in (
        (cf.fit_naive_bayes, cf.load_naive_bayes, "bayes"),
        (cf.fit_decision_tree, cf.load_decision_tree, "tree"),
    ):
        model = fit(df, classes)
        path = str(tmp_path / name)
        cf.save_model(model, path, [0.0])
        cf.save_model(model, path, classes)
        before = {r.id: r.prediction for r in cf.predict(model, df, classes).collect()}
        loaded, known = load(path)
        assert {r.id: r.prediction for r in cf.predict(loaded, df, known).collect()} == before
    lines = [r.line for r in cf.tree_lines(model, df).orderBy("n").collect()]
    assert lines[0].startswith("DecisionTreeClassificationModel") and any("Predict" in line for line in lines)


def test_many_classes(spark):
    df, rows = labelled(spark, 600, tuple(float(c) for c in range(150)))
    assert cf.decision_tree(df).count() == cf.naive_bayes(df).count() == cf.split_by_id(df)[1].count()
