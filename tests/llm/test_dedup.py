"""Near-duplicate and repeated-text operators against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from kithwork.llm import components as components_module, embedding_dedup, minhash_dedup, substring_dedup
from kithwork.llm.components import components
from kithwork.llm.tables import settings, stored
from tables_for_tests import as_dict, awkward, documents, words

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingle_set(text, size=5):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def roots(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_minhash(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [
        (a, b) for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    root = roots(sets, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def near_copies(seed, base, n, edits):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def copies():
    texts = [" ".join(words(s, 60)) for s in range(20)]
    texts += near_copies(1, words(100, 300), 40, 2) + near_copies(2, words(101, 120), 12, 1) + [texts[3].upper()] * 3 + ["a b c", "A b  c", "a", "", None]
    order = random.Random(9).sample(range(1000), len(texts))
    return list(zip(order, texts))


def test_minhash_equals_brute_force(spark, copies):
    found = minhash_dedup.minhash_dedup(documents(spark, [(i, t, "en") for i, t in copies]))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert as_dict(found, "n_shingles", "component_id", "kept") == brute_minhash(copies)


def test_minhash_with_tiles_equals_brute_force(spark, copies, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TILE_DOCS", 7)
    found = minhash_dedup.minhash_dedup(documents(spark, [(i, t, "en") for i, t in copies]))
    assert as_dict(found, "n_shingles", "component_id", "kept") == brute_minhash(copies)


def test_minhash_awkward_and_empty(spark):
    table = awkward(spark)
    rows = minhash_dedup.minhash_dedup(table).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 3, 4, 5, 6, 7]
    found = {r["doc_id"]: r for r in rows}
    assert found[5]["component_id"] == 4 and not found[5]["kept"]
    assert [found[i]["n_shingles"] for i in (1, 2, 3, 6)] == [0, 0, 0, 1] and all(found[i]["kept"] for i in (1, 2, 3, 6))
    assert minhash_dedup.minhash_dedup(table.limit(0)).count() == 0


def test_intersections_are_exact():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 300, r.integers(1, 200)).astype(np.uint64)) for _ in range(60)]
    for dense_from in (2, 8, 1000):
        common = minhash_dedup.intersections(sets, dense_from)
        assert all(common[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(60) for j in range(60))


def test_tensored_keys_reach_their_recall():
    r = np.random.default_rng(5)
    hits = 0
    for _ in range(300):
        common, own = r.integers(0, 1 << 60, 170).astype(np.uint64), r.integers(0, 1 << 60, 30).astype(np.uint64)
        a, b = (minhash_dedup.banding_parts(np.unique(np.concatenate((common, x)))) for x in (own[:15], own[15:]))
        same = a == b
        hits += same[: minhash_dedup.SIDE].any() and same[minhash_dedup.SIDE :].any()
    assert hits >= 299


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 200)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_links_are_few_tasks_and_stars_end_the_rounds(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components_module, "stored", lambda df, name: made.append(stored(df, name)) or made[-1])
    with settings(spark, spark__sql__shuffle__partitions="37", spark__sql__adaptive__coalescePartitions__enabled="false"):
        star = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(1000, 1001)], "a long, b long")
        assert {r["component"] for r in components(star).collect()} == {0, 1000} and len(made) == 1
        path = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
        assert [r["component"] for r in components(path, most=9).collect()] == [0] * 10
    assert len(made) > 2 and all(len(df.inputFiles()) <= spark.sparkContext.defaultParallelism for df in made[1:])


def brute_vectors(rows):
    unit = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            unit[i] = (label, np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links = [(a, b) for a, b in itertools.combinations(sorted(unit), 2) if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.93]
    ids = {i for i, *_ in rows if i is not None}
    root = roots(ids, links)
    return {i: (sum(i in link for link in links), root[i], root[i] == i) for i in ids}


def vectors(seed=0, n=150, dim=24):
    r = np.random.default_rng(seed)
    rows = [(i, int(r.integers(3)), [float(np.float32(x)) for x in r.normal(size=dim)]) for i in range(n)]
    for k in range(60):
        i, label, v = rows[int(r.integers(n))]
        rows.append((n + k, label, [float(np.float32(x + r.normal() * 0.15)) for x in v]))
    rows += [(n + 100 + k, rows[0][1], rows[0][2]) for k in range(4)]
    rows += [(900, None, rows[0][2]), (901, 1, None), (902, 1, []), (903, 1, [0.0] * dim), (904, 1, [1.0, None] + [0.0] * (dim - 2)), (905, 1, [float("nan")] + [1.0] * (dim - 1)),
             (906, 1, [float("inf")] * dim), (907, 1, [1.0, 2.0]), (908, 1, [1.0, 2.001]), (None, 1, rows[0][2])]
    return rows


VECTORS = "vec_id long, label int, embedding array<float>, component_id string, z string, tile string"


@pytest.mark.parametrize("tile", [1024, 16])
def test_embeddings_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup.tiled, "__defaults__", (tile,))
    rows = vectors()
    table = spark.createDataFrame([(i, label, v, "a", "b", "c") for i, label, v in [*rows, rows[3]]], VECTORS)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.embedding_dedup(table).collect()}
    assert found == brute_vectors(rows)


def test_embeddings_take_wide_labels(spark):
    rows = [(1, [1.0, 2.0], 5_000_000_000), (2, [2.0, 4.0], 5_000_000_000), (3, [1.0, 2.0], 705_032_704)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    assert {r["vec_id"]: r["component_id"] for r in embedding_dedup.embedding_dedup(table).collect()} == {1: 1, 2: 1, 3: 3}


def test_embeddings_of_empty_tables(spark):
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], VECTORS)).count() == 0
    only_bad = spark.createDataFrame([(1, 1, None, "", "", ""), (2, None, [1.0], "", "", "")], VECTORS)
    assert {r["vec_id"]: r["kept"] for r in embedding_dedup.embedding_dedup(only_bad).collect()} == {1: True, 2: True}


def brute_repeats(rows, least=5):
    seen, out = set(), {}
    for i, text in sorted(rows):
        kept, spans, at = [], [], 0
        for unit in re.findall(r"(?s).*?(?:\n|[.!?] )|.+", text or ""):
            w = tuple(re.findall("[^\x20\x09-\x0d]+", unit.translate(LOW)))
            if len(w) >= least and w in seen:
                spans.append((at, at + len(unit)))
            else:
                kept.append(unit)
                seen.add(w)
            at += len(unit)
        out[i] = ("".join(kept) if text is not None else None, spans)
    return out


def test_repeated_units_equal_brute_force(spark):
    r = random.Random(4)
    pool = [" ".join(words(s, r.randrange(1, 14), 50)) + r.choice([". ", "! ", "\n", " ", "? "]) for s in range(80)]
    rows = [(i, "".join(r.choice(pool).replace("w1", "ü1") for _ in range(r.randrange(0, 12)))) for i in random.Random(1).sample(range(500), 60)]
    rows += [(1000, None), (1001, ""), (1002, ". . ! \n\n"), (1003, " ".join(words(8, 5000)) + "\n")]
    found = substring_dedup.substring_dedup(documents(spark, [(i, t, "en") for i, t in rows]))
    got = {x["doc_id"]: (x["text"], [(s["start"], s["stop"]) for s in x["removed"]]) for x in found.collect()}
    assert got == brute_repeats(rows)


def test_repeats_awkward_and_empty(spark):
    table = awkward(spark)
    found = substring_dedup.substring_dedup(table).collect()
    assert len(found) == table.count()
    assert {r["doc_id"]: r["text"] for r in found}[5] == "" and {r["doc_id"]: r["text"] for r in found}[1] is None
    assert [r["text"] for r in found if r["doc_id"] is None] == ["null id"]
    assert substring_dedup.substring_dedup(table.limit(0)).count() == 0
