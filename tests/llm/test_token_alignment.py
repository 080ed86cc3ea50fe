"""Token alignment against brute force over all pairs of byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kithwork.llm.token_alignment import Aligner, Kept, alignment_report, byte_level_path, byte_of_character, piece_path, token_alignment
from kithwork.llm.words import column_bytes
from tables_for_tests import awkward, documents, words

AWKWARD = [
    "héllo 日本語 🙂 á  b\n\tc", "", "ＡＢ full width 鿃", "<|endoftext|> x </s> <unk> <0x41>", "▁ odd", "  two  blanks ", "日本", "鿃", "a" * 300, " ",
    "\n", "🙂🙂鿃🙂 zażółć", "é ​ x", "\x00 \x01z", "ﬁ ① ½", " nbsp", "tab\t\ttab", "…—“q”", "﻿mark", "\r\n", "क्षि ไทย עברית",
]


class Brute:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(byte_level_path()), sentencepiece.SentencePieceProcessor(model_file=piece_path())
        self.a.encode_special_tokens = True
        self.byte = byte_of_character()

    def spans(self, tokens):
        at, out = 0, []
        for i, piece in tokens:
            out.append((i, at, at + len(piece)))
            at += len(piece)
        return out

    def __call__(self, text):
        """(n_a, n_b, n_groups, n_links, groups, links per pair)"""
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + (text or ""), add_special_tokens=False).ids]
        pieces = [(i, self.b.id_to_piece(i)) for i in self.b.encode(text or "")]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(p for _, p in side) != raw for side in (a, b)):
            return 0, 0, 0, 0, "", {}
        a, b = self.spans(a), self.spans(b)
        groups, start = [], 0
        for end in sorted({e for *_, e in a} & {e for *_, e in b}):
            groups.append("|".join(",".join(str(i) for i, x, y in side if start <= x and y <= end) for side in (a, b)))
            start = end
        links = Counter(i << 32 | j for i, x, y in a for j, u, v in b if x < v and u < y)
        return len(a), len(b), len(groups), sum(links.values()), ";".join(groups), dict(links)


@pytest.fixture(scope="module")
def brute():
    return Brute()


@pytest.fixture(scope="module")
def texts():
    r = random.Random(2)
    signs = ["é", "日", "鿃", "🙂", " ", "\n", "ab", "the ", "▁", "Ａ", "'s", "123", "́"]
    made = ["".join(r.choice(signs) for _ in range(r.randint(1, 40))) for _ in range(150)]
    return AWKWARD + made + [" ".join(words(k, 50)) for k in range(5)] + [None]


def test_aligner_equals_brute_force(brute, texts):
    with open(byte_level_path()) as a, open(piece_path(), "rb") as b:
        align = Aligner(a.read(), b.read())
    own = [t or "" for t in texts]
    *counts, groups, of, pair, links = align(own)
    for k, text in enumerate(own):
        found = (*(int(c[k]) for c in counts), groups[k], {int(p): int(n) for t, p, n in zip(of, pair, links) if t == k})
        assert found == brute(text), text
    empty = align([])
    assert [len(x) for x in empty] == [0] * 8


def test_texts_from_kept_stretches_equal_whole_texts():
    r = random.Random(6)
    signs = ["\u00a0", "\u2003", "\u3000", "\x85", "’", "é", "日", "鿃", "🙂", " ", "\n", "ab", "the ", "▁", "Ａ", "'s", "123", "  ", " x"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(1500)] + [" ".join(words(k, 40)) for k in range(20)]
    with open(byte_level_path()) as a, open(piece_path(), "rb") as b:
        align = Aligner(a.read(), b.read())
    kept = Kept(align)
    for _ in range(2):
        found, whole = kept(*column_bytes(pa.array(texts))), align(texts)
        assert all(list(x) == list(y) for x, y in zip(found, whole))
    empty = kept(*column_bytes(pa.array([None, ""], pa.string())))
    assert [len(x) for x in empty] == [2] * 5 + [0] * 3 and empty[4] == ["", ""]


def test_report_equals_brute_force(spark, brute, texts):
    rows = [(k, t, "en") for k, t in enumerate(texts)] + [(5, texts[0], "en"), (None, texts[0], "en")]
    found = alignment_report(token_alignment(documents(spark, rows))).collect()
    own = [(i, brute(t)) for i, t, _ in rows]
    count = Counter(p for _, x in own for p in x[5])
    most = defaultdict(int)
    for p, n in count.items():
        most[p >> 32] = max(most[p >> 32], n)
    expected = []
    for i, (n_a, n_b, n_groups, n_links, groups, links) in own:
        best = sum(n for p, n in links.items() if count[p] == most[p >> 32])
        expected.append((i, n_a, n_b, n_groups, n_links, best, sum(n * count[p] for p, n in links.items()), hashlib.sha256(groups.encode()).hexdigest() if n_a else ""))
    order = lambda rows: sorted(rows, key=repr)
    assert order(tuple(r) for r in found) == order(expected)


@pytest.mark.parametrize("frequent", [0, 1, 1 << 40])
def test_broadcast_share_does_not_change_the_sums(spark, texts, frequent):
    from kithwork.llm import token_alignment as module
    from pyspark.sql import functions as F

    aligned = token_alignment(documents(spark, [(k, t, "en") for k, t in enumerate(texts[:40])])).drop("groups").withColumn("row", F.monotonically_increasing_id())
    found = [sorted(tuple(r) for r in module.with_pair_counts(module.stored(aligned, "t"), share).select("doc_id", "n_best", "count_sum").collect()) for share in (frequent, module.FREQUENT)]
    assert found[0] == found[1] and any(r[2] for r in found[0])


def test_awkward_tables(spark):
    rows = alignment_report(token_alignment(awkward(spark))).collect()
    assert len(rows) == 9 and sum(r["doc_id"] is None for r in rows) == 1
    assert [tuple(r)[1:] for r in rows if r["doc_id"] in (1, 2)] == [(0, 0, 0, 0, 0, 0, "")] * 2
    same = [tuple(r)[1:] for r in rows if r["doc_id"] in (4, 5)]
    assert same[0] == same[1] and same[0][0] > 30_000
    assert alignment_report(token_alignment(awkward(spark).where("false"))).count() == 0
