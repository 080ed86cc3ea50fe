"""Byte-string dedup against brute force: windows of every text in a dictionary."""

import hashlib
import random

import numpy as np
import pytest

from kithwork.llm.repeated_bytes import equal_prefixes, remove_repeated_bytes, removal_report, suffix_order
from tables_for_tests import awkward, documents, words


def brute(rows, least):
    """(doc_id, text) -> (removed spans, kept) with texts of one id told apart by their text only."""
    first, texts = {}, {(i, t): (t or "").encode() for i, t in rows}
    for (i, t), raw in texts.items():
        for s in range(len(raw) - least + 1) if i is not None else ():
            first[raw[s : s + least]] = min(first.get(raw[s : s + least], (i, s)), (i, s))
    out = {}
    for (i, t), raw in texts.items():
        gone = np.zeros(len(raw) + 2, bool)
        for s in range(len(raw) - least + 1) if i is not None else ():
            if first[raw[s : s + least]] < (i, s):
                gone[1 + s : 1 + s + least] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2).tolist()
        out[i, t] = ([tuple(e) for e in edges], raw and bytes(b for b, g in zip(raw, gone[1:]) if not g))
    return out


def found(spark, rows, least, block=1 << 19):
    docs = documents(spark, [(i, t, "en") for i, t in rows])
    out = remove_repeated_bytes(docs, least, block).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"]) for r in out) == sorted((i is None, i or 0, len((t or "").encode())) for i, t in rows)
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, [tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in out)


def expected(rows, least):
    own = brute(rows, least)
    return sorted((i is None, i or 0, *own[i, t]) for i, t in rows)


def corpus(seed, n):
    r = random.Random(seed)
    passages = [" ".join(words(k, r.randint(5, 60))) for k in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(words(1000 * seed + i, r.randint(0, 60)))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randrange(len(p))
            parts += [p[a : a + r.randint(10, 300)], r.choice(["", "é", "日本", "x" * r.randint(0, 90), "ab" * r.randint(0, 150)])]
        rows.append((i * 7 % n, "".join(parts)))
    return rows


@pytest.mark.parametrize("least,block", [(100, 1 << 19), (40, 1 << 19), (100, 0), (30, 300), (10, 200)])
def test_equal_to_brute_force(spark, least, block):
    """Also with blocks so small that most keys are dealt out window by window."""
    rows = corpus(least, 120)
    assert found(spark, rows, least, block) == expected(rows, least)


def test_copies_ties_and_one_repeated_passage(spark):
    shared = "All rights are reserved by whoever wrote this passage of well over one hundred bytes, that many documents hold."
    rows = [(i, f"{'x' * (i % 7)}{shared}{i}") for i in range(60)] + [(100 + i, shared * 3) for i in range(20)] + [(200, "a" * 5000), (201, "a" * 130), (202, "ab" * 400)]
    assert found(spark, rows, 100) == expected(rows, 100)
    assert found(spark, rows, 100, 0) == expected(rows, 100)


def test_awkward_tables(spark):
    long = " ".join(words(5, 30_000))
    docs = awkward(spark)
    rows = {(r["doc_id"], r["n_bytes"], len(r["removed"]), bytes(r["kept"])) for r in remove_repeated_bytes(docs).collect()}
    assert (1, 0, 0, b"") in rows and (2, 0, 0, b"") in rows and (None, 7, 0, b"null id") in rows
    assert (5, len(long), 1, b"") in rows and (7, len("ünï çødé €".encode()), 0, "ünï çødé €".encode()) in rows
    assert remove_repeated_bytes(docs.where("false")).count() == 0


def test_rows_that_repeat_an_id(spark):
    """With its text: one document. With another text: one of the two keeps a string that starts at the same byte."""
    shared = " ".join(words(3, 60))
    same = found(spark, [(1, shared), (1, shared), (2, "b " + shared)], 100)
    assert [s[2] for s in same] == [[], [], [(2, 2 + len(shared))]]
    other = found(spark, [(1, shared + "1"), (1, shared + "2")], 100)
    assert sorted(len(s[2]) for s in other) == [0, 1]


def test_report(spark):
    text = " ".join(words(9, 80))
    row = removal_report(remove_repeated_bytes(documents(spark, [(1, text, "en"), (2, text + "!", "en")]))).where("doc_id = 2").first()
    assert row.asDict() == {"doc_id": 2, "n_bytes": len(text) + 1, "n_removed": len(text), "n_spans": 1, "kept_sha256": hashlib.sha256(b"!").hexdigest()}


def test_backward_extension_gives_the_prefix_groups():
    r = random.Random(4)
    for n, kinds, least in [(1, 1, 3), (50, 1, 7), (300, 2, 5), (300, 3, 20), (400, 200, 2)]:
        symbols = np.array([r.randint(1, kinds) for _ in range(n)] + [0], np.uint16)
        order = suffix_order(symbols, least)
        turned = [tuple(np.roll(symbols, -i)[:least]) for i in order]
        group = equal_prefixes(symbols, order, least)
        inner = [k for k in range(1, len(order)) if 0 not in turned[k] or 0 not in turned[k - 1]]
        assert all((group[k] == group[k - 1]) == (turned[k] == turned[k - 1]) for k in inner)
        assert [t for t in turned if 0 not in t] == sorted(t for t in turned if 0 not in t)
