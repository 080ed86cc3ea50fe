"""Ratings packed in cells: groups, hot ids, nulls and repeated rows, and what a half-round shuffles."""

import random

import numpy as np
import pytest

from kithwork.operators import cells, factorize as fz


@pytest.fixture
def small(monkeypatch):
    """Limits under which a few hundred ratings make several groups, cells and slices."""
    for name, value in (("LEAST_RATINGS", 60), ("CELL_RATINGS", 70), ("SLICE", 16), ("UNPACKED", 7)):
        monkeypatch.setattr(cells, name, value)


def awkward_rows():
    rng = random.Random(4)
    rows = [(rng.randrange(1, 50), rng.randrange(1, 40), rng.randint(1, 5)) for _ in range(300)]
    rows += rows[:30] + [(1, i, 3) for i in range(60)] + [(u, 2, 4) for u in range(60)]
    rows += [(None, 3, 2), (None, 77, 5), (4, None, 1), (88, None, 2), (None, None, 3), (5, 3, None), (91, 92, None), (91, 3, 2), (95, 92, 4), (96, 97, None)]
    return rows


def sql_als(rows, k, rounds, users):
    """Factors by id; None: there are ratings, but all products with them are null. Nobody meets a null id."""
    items = {}
    for _ in range(rounds):
        for by_user, source, target in ((True, users, items), (False, items, users)):
            sums = {}
            for u, i, r in rows:
                by, key = (u, i) if by_user else (i, u)
                if by is None or by not in source:
                    continue
                m, v, rated = sums.setdefault(key, [np.eye(k), np.zeros(k), False])
                f = source[by]
                if f is not None:
                    sums[key] = [m + np.outer(f, f), v + (0 if r is None else r) * f, rated or r is not None]
            target.clear()
            target.update({key: np.linalg.solve(m, v) if rated else None for key, (m, v, rated) in sums.items()})
    return users, items


def start(rows, k):
    modulus, multiplier = 2147483647, 742938285
    return {u: np.array([((u % modulus) * pow(multiplier, s + 1, modulus) + 7) % modulus / modulus for s in range(k)]) for u, _, _ in rows if u is not None}


def same(frame, key, expected):
    found = {r[key]: r.factors for r in frame.collect()}
    assert found.keys() == expected.keys() and frame.count() == len(expected)
    for name, vector in expected.items():
        assert found[name] == ([None] * len(found[name]) if vector is None else pytest.approx(list(vector), abs=1e-8))


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("k", [1, 5])
def test_packed_factors_equal_sums_in_sql(request, spark, small, k, hot):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating int").repartition(3)
    if hot:
        request.getfixturevalue("skewed")
        rows = [r for r in rows if None not in r[:2]]
        df = df.where("user_id is not null and item_id is not null")
    expected = sql_als(rows, k, 3, start(rows, k))
    users, items = fz.als_factors(df, k=k, rounds=3)
    same(users, "user_id", expected[0])
    same(items, "item_id", expected[1])


def test_a_half_round_is_one_task_a_group_and_shuffles_nothing(spark, small):
    rows = [r for r in awkward_rows() if None not in r]
    df = spark.createDataFrame([(u, i, float(r)) for u, i, r in rows], "user_id bigint, item_id bigint, rating double").repartition(3)
    packed = cells.Packed(df, len(rows), ([], []), 2, 4)
    assert packed.items.groups == packed.users.groups == 4 and set(packed.cells) == {s.first + g for s in (packed.items, packed.users) for g in range(4)}
    users = packed.start(fz.start_factors(packed.ids["user_id"], "user_id", 2), ["f0", "f1"])
    items = packed.half_round(packed.items, users, 1.0)
    assert items.rdd.getNumPartitions() == 4 and items.count() == 4
    assert "Exchange" not in items._jdf.queryExecution().executedPlan().toString()
    packed.remove()


def test_no_ratings_no_factors(spark):
    users, items = fz.als_factors(spark.createDataFrame([], "user_id bigint, item_id bigint, rating int"), rounds=1)
    assert users.count() == items.count() == 0 and users.columns == ["user_id", "factors"]


def test_groups_bound_what_a_task_holds():
    assert cells.groups(600_000, 20_000, 5, 6) == 3 and cells.groups(10, 5, 5, 6) == 1
    many = cells.groups(214_000_000, 7_200_000, 5, 6)
    assert many % 6 == 0 and 7_200_000 / many * cells.width(5) * 8 <= cells.SUM_BYTES and 214_000_000 / many <= cells.GROUP_RATINGS


def test_cells_wait_for_their_block_in_any_order():
    rng = np.random.default_rng(3)
    factors, state = rng.random((5, 2)), np.full(5, cells.FOUND | cells.RATED, np.uint8)
    cell = cells.Cell(np.array([0, 0, 2], np.int32), np.array([1, 4, 0], np.int32), np.array([0, 1, 0], np.uint8), np.array([3.0, 0.0]), 1)
    rows = [cells._packed_row(0, 0, tuple(cell)), cells._packed_row(0, 1, tuple(cell)), cells._packed_row(cells.FACTORS, 0, (factors, state)), cells._packed_row(cells.FACTORS, 1, (factors * 2, state))]
    want = cells._added(iter(rows), 3, 2, 2)
    assert want.state.tolist() == [3, 0, 3] and want.sums[0, 2] == pytest.approx(5 * factors[0, 0] ** 2)
    for order in ((2, 0, 1, 3), (3, 2, 1, 0), (0, 3, 2, 1)):
        found = cells._added(iter([rows[n] for n in order]), 3, 2, 2)
        assert np.allclose(found.sums, want.sums) and (found.state == want.state).all()
