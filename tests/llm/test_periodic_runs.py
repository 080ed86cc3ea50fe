"""Runs of words against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from kithwork.llm.periodic_runs import kept_words, periodic_runs, planted, run_report, runs_of_texts, split_words
from kithwork.llm.words import column_bytes
from tables_for_tests import awkward, documents, words


def brute(w, least):
    found = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            n = j - i + p
            if j > i and n >= max(least, 2 * p) and not any(all(w[i + k] == w[i + k + q] for k in range(n - q)) for q in range(1, p)):
                found.append((i, n, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def replanted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_equal_to_brute_force(seed):
    r = random.Random(seed)
    for _ in range(60):
        texts = []
        for _ in range(r.randint(1, 6)):
            w = [f"w{r.randrange(r.choice([1, 2, 3, 5]))}" for _ in range(r.randint(0, 70))]
            if w and r.random() < 0.5:
                a = r.randrange(len(w))
                p = 1 + (len(w) - a) // r.randint(2, 9)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            texts.append(" \n".join(w))
        least = r.choice([2, 3, 5, 8, 12, 13])
        text = split_words(*column_bytes(pa.array(texts)))
        runs, of = runs_of_texts(text, least)
        kept = kept_words(runs, len(text.ids))
        for t, whole in enumerate(texts):
            own = [(int(s - text.first[t]), int(n), int(p)) for s, n, p in zip(*(x[of == t] for x in runs))]
            assert own == brute(whole.split(), least)
            left = [x for x, k in zip(whole.split(), kept[text.first[t] : text.first[t + 1]]) if k]
            assert " ".join(left) == collapsed(whole.split(), own)


def test_query_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, "\t ".join(words(i, r.randint(0, 90), r.choice([2, 5, 300]))) + " é日本 " * (i % 3) * 8, "en") for i in range(200)]
    out = {x["doc_id"]: x for x in run_report(periodic_runs(planted(documents(spark, rows)))).collect()}
    assert len(out) == len(rows) and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows) > 5
    for i, text, _ in rows:
        w = replanted(i, text.split())
        runs = brute(w, 12)
        s, n, p = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else (None,) * 3
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(w, runs))]
        assert tuple(out[i]) == (i, len(runs), s, n, p, n and 1000 * n // p, *digests)


def test_awkward_tables(spark):
    rows = [tuple(x) for x in run_report(periodic_runs(planted(awkward(spark)))).collect()]
    nothing = hashlib.sha256(b"").hexdigest()
    assert (1, 0, None, None, None, None, nothing, nothing) in rows and (2, 0, None, None, None, None, nothing, nothing) in rows
    assert sum(x[0] == 6 for x in rows) == 2 and sum(x[0] is None for x in rows) == 1 and len(rows) == 9
    assert periodic_runs(awkward(spark).where("false")).count() == 0


def test_one_word_a_hundred_thousand_times(spark):
    docs = documents(spark, [(1, "na " * 100_000, "en"), (2, "x " + "a b " * 20_000 + "a", "en")])
    out = {r["doc_id"]: r for r in periodic_runs(docs).collect()}
    assert [tuple(x) for x in out[1]["runs"]] == [(0, 100_000, 1)] and out[1]["text"] == "na"
    assert [tuple(x) for x in out[2]["runs"]] == [(1, 40_001, 2)] and out[2]["text"] == "x a b"


def test_words_are_split_at_text_borders():
    text = split_words(*column_bytes(pa.array(["a b", "b a", None, " ", "ab"])))
    assert np.diff(text.first).tolist() == [2, 2, 0, 0, 1] and text.ids.tolist()[:4] == [0, 1, 1, 0]
