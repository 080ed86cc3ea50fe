"""Learned operators: exact parts against brute force, the rest by held-out accuracy."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kithwork.llm import language_id, lm_scoring, quality, toxicity
from tables_for_tests import LABELS, as_dict, awkward, documents, words

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def crc(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


@pytest.fixture(scope="module")
def labelled():
    """Good and bad texts, a sixth of the good ones with an insult."""
    r = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        good, toxic = i % 3 > 0, i % 6 == 1
        w = words(i, r.randrange(20, 200), 3000)
        if not good:
            w = [f"{x.upper()}!!" for x in w]
        if toxic:
            w[r.randrange(len(w))] = r.choice(["blockhead", "numbskull"])
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(good), int(toxic), "clash"))
    return rows, [*labels, (3, None, None, "null"), (9999, 1, 1, "no such document"), (None, 1, 0, "null id")]


def accuracy(df, want):
    rows = [r for r in df.collect() if r["held_out"]]
    assert len(rows) > 40 and all(0 <= r["score"] <= 1 for r in rows)
    return sum(r["predicted"] == want[r["doc_id"]] for r in rows) / len(rows)


def test_quality_on_held_out_rows(spark, labelled):
    rows, labels = labelled
    found = quality.quality(documents(spark, rows), spark.createDataFrame(labels, LABELS)).cache()
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert accuracy(found, {i: q for i, q, _, _ in labels[:400]}) > 0.95
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and r["predicted"] == (r["score"] >= 0.7) for r in found.collect())
    kept = quality.keep_good(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert kept.columns == documents(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found.collect() if r["predicted"]}


def test_toxicity_on_held_out_rows(spark, labelled):
    rows, labels = labelled
    found = toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, LABELS)).cache()
    assert accuracy(found, {i: t for i, _, t, _ in labels[:400]}) > 0.95
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in found.collect())


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_labels_of_held_out_rows_do_not_matter(spark, labelled, operator):
    rows, labels = labelled
    modulus, fold = (4, 2) if operator is quality.quality else (5, 0)
    turned = [(i, 1 - q, 1 - t, x) if i is not None and q is not None and crc(i, modulus) == fold else (i, q, t, x) for i, q, t, x in labels]
    table = documents(spark, rows[:200])
    scores = [as_dict(operator(table, spark.createDataFrame(x, LABELS)), "score") for x in (labels, turned)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_scores_of_awkward_tables(spark, labelled, operator):
    table = awkward(spark)
    labels = spark.createDataFrame(labelled[1], LABELS)
    assert operator(table, labels).count() == table.count()
    none = operator(table, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5} and {r["held_out"] for r in none if r["doc_id"] is None} == {None}
    assert operator(table.limit(0), labels).count() == 0


def test_toxicity_features_equal_sets_of_grams():
    text = "Worthless ünit"
    own = toxicity.distinct_features([text.encode()])[0]
    grams = {(" " + text.lower())[k : k + n] for n in toxicity.SIZES for k in range(len(text) + 2 - n)}
    assert len(grams) * 0.97 <= len(own) <= len(grams)


def test_log_count_ratios():
    found = toxicity.log_count_ratios(np.array([3.0, 0.0]), np.array([1.0, 1.0]))
    assert np.allclose(found, [math.log((4 / 5) / (2 / 4)), math.log((1 / 5) / (2 / 4))])


def brute_lm(rows):
    tokens = [(i, re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOW)) + [None]) for i, t in rows]
    counts = Counter(w for i, own in tokens if i is not None and crc(i, 7) != 2 for w in own)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (-1 if i is None else i, None if i is None else crc(i, 7) == 2, len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 6))
        for i, own in tokens
    )


@pytest.mark.parametrize("head", [1 << 20, 8, 0])
def test_language_model_base_equals_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    table = awkward(spark).unionByName(documents(spark, [(100 + i, " ".join(words(i, 80, 60)).title(), "en") for i in range(40)]))
    rows = lm_scoring.lm_scores(table).collect()
    want = brute_lm([(r["doc_id"], r["text"]) for r in table.collect()])
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows) == want
    assert all(r["score"] < 0 for r in rows)


def test_language_model_of_empty_tables(spark):
    table = awkward(spark)
    assert lm_scoring.lm_scores(table.limit(0)).count() == 0
    only = lm_scoring.lm_scores(documents(spark, [(next(i for i in range(100) if crc(i, 7) == 2), "a b", "en")])).collect()[0]
    assert (only["n_tokens"], only["n_known"], only["train_tokens"], only["base_score"]) == (3, 0, 0, 0.0)


def test_filter_gives_back_quantised_counts():
    r = np.random.default_rng(1)
    grams = np.unique(r.integers(0, 1 << 63, 20_000).astype(np.uint64))
    counts = np.maximum(lm_scoring.LEAST, (r.pareto(1, len(grams)) * 2).astype(np.int64))
    size = 1 << (int(lm_scoring.levels(counts).sum()) * lm_scoring.BITS_PER_ENTRY // 8).bit_length()
    part = np.frombuffer(lm_scoring.filter_part(grams, counts, size, lm_scoring.PROBES), np.uint8)[None, :]
    held = lm_scoring.LogFrequencyFilter(part, lm_scoring.PROBES)
    exact = lm_scoring.level_middle(lm_scoring.levels(counts))
    found = held.counts(grams)
    assert (found >= exact).all() and (found == exact).mean() > 0.97
    assert (np.abs(exact / counts - 1) <= 0.5).all()
    assert (held.counts(r.integers(1 << 62, 1 << 63, 20_000).astype(np.uint64)) > 0).mean() < 0.03


@pytest.mark.parametrize("segment", [1, 2, 3, 128])
def test_forward_backward_equals_all_paths(monkeypatch, segment):
    monkeypatch.setattr(language_id, "SEGMENT", segment)
    r = np.random.default_rng(0)
    lengths, k = np.array([5, 1, 4]), 3
    scores, transitions = r.normal(size=(10, k)), r.normal(size=(k, k))
    want, switches, at = np.zeros((10, k)), np.zeros((k, k)), 0
    for n in lengths:
        total, own, moved = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for path in itertools.product(range(k), repeat=int(n)):
            weight = math.exp(sum(scores[at + i, path[i]] for i in range(n)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for i in range(n):
                own[i, path[i]] += weight
            for a, b in zip(path, path[1:]):
                moved[a, b] += weight
        want[at : at + n], switches, at = own / total, switches + moved / total, at + n
    found = language_id.forward_backward(scores, lengths, transitions, expected=True)
    assert np.allclose(found.words, want) and np.allclose(found.switches, switches)


SYLLABLES = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["schn", "eib", "ung", "zel"], "cc": ["ção", "lhé", "inho", "ês"]}


def spoken(seed, lang, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randrange(1, 4))) for _ in range(n))


def test_languages_on_held_out_rows_and_mixed_text(spark):
    rows = [(i, spoken(i, sorted(SYLLABLES)[i % 3], 30), sorted(SYLLABLES)[i % 3]) for i in range(90)]
    table = documents(spark, [*rows, (500, None, "aa"), (501, "12 !! --", "aa"), (502, "", "bb"), (503, "karo mi", None), (None, "zelung eib", "bb")])
    found = {r["doc_id"]: r for r in language_id.language_id(table).collect()}
    held = [i for i in range(90) if crc(i, 3) == 1]
    assert held and all(found[i]["held_out"] and found[i]["lang_pred"] == rows[i][2] for i in held)
    assert [(found[i]["lang_pred"], found[i]["score"]) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert found[503]["lang_pred"] == "aa" and found[None]["lang_pred"] == "bb" and found[None]["held_out"] is None
    model = language_id.fit_languages([(lang, text) for _, text, lang in rows])
    mixed = f"{spoken(1001, 'aa', 6)} {spoken(1002, 'bb', 6)} {spoken(1003, 'cc', 6)}"
    labels = [lang for _, lang, _ in language_id.word_languages(model, [mixed])[0]]
    assert labels == ["aa"] * 6 + ["bb"] * 6 + ["cc"] * 6


def test_languages_without_training_rows(spark):
    table = awkward(spark, lang=None)
    assert {r["lang_pred"] for r in language_id.language_id(table).collect()} == {"und"}
    assert language_id.language_id(table.limit(0)).count() == 0
