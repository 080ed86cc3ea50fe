"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) and a sentencepiece model (B) share bytes.

A reads a blank and the text, B the text, to which it adds the blank itself; both then cover the same bytes.

1. Coarse cuts come from the libraries: the character offsets of A, and for B the spans of sentencepiece's proto
   (the class that was called immutable proto is gone from the library; ``offset_mapping`` gives its spans). A
   cut is taken where one token ends and the next begins at the same character.
2. Tokens that share a character (parts of a multibyte character in A, byte-fallback tokens in B, which have
   empty spans but for the last) stand between two coarse cuts. There the lengths of their decoded bytes refine.
3. The decoded bytes of each side, put together, must be the bytes of the blank and the text; a text for which
   they are not has no tokens.

Byte offsets where tokens of both sides end cut them into groups; a link is a pair of tokens whose bytes overlap.

Neither side has tokens across a single blank between two characters that are no white space: A splits texts there
first, and no piece of B has a blank behind another character (checked when a model is loaded). So tokens of both
sides end before each such blank, the stretches between them are aligned independently, and one that was seen before is not aligned again.

How many documents hold an id pair linked is counted with partial sums. At most ``FREQUENT`` pairs can have more
than that share of all rows; their counts are broadcast, the rest meets its counts in a join without hot keys.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from kithwork.llm.tables import stored
from kithwork.llm.words import column_bytes, lean, slices

# Pairs with at least this part of the rows have their counts broadcast: no more pairs than that exist.
FREQUENT = 1 << 17
# Stretches of a task that are kept, and the longest one kept, in bytes.
KEPT, KEPT_BYTES = 500_000, 64
# New stretches are aligned together in texts of about this size.
CHUNK_BYTES = 1 << 14
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<pair: long, links: int>>"
# An id pair as one number: id of A times 2^32 plus id of B.
SHIFT = 32


def byte_level_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def byte_of_character() -> dict[str, int]:
    """Byte-level tokens write a byte as a character: itself where printable, else the next from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary(NamedTuple):
    """Bytes of all ids: those of id i are ``data[first[i] : first[i] + size[i]]``."""

    first: np.ndarray
    size: np.ndarray
    data: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return Vocabulary(np.cumsum(size) - size, size, np.frombuffer(b"".join(tokens), np.uint8))

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[ids] - (ends - size), size)]


class Tokens(NamedTuple):
    """Tokens of the texts of a slice; ``first[t]`` to ``first[t + 1]`` belong to text t."""

    ids: np.ndarray
    first: np.ndarray
    low: np.ndarray  # spans as the library gives them, in characters of the blank and the text
    high: np.ndarray


def _tokens(parts: list[tuple[list[int], list[tuple[int, int]]]], shift: int) -> Tokens:
    counts = np.array([len(ids) for ids, _ in parts], np.int64)
    total = int(counts.sum())
    ids = np.fromiter(chain.from_iterable(ids for ids, _ in parts), np.int64, total)
    spans = np.fromiter(chain.from_iterable(chain.from_iterable(spans for _, spans in parts)), np.int64, 2 * total).reshape(-1, 2) + shift
    return Tokens(ids, np.concatenate(([0], np.cumsum(counts))), spans[:, 0], spans[:, 1])


class ByteLevel:
    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        byte = byte_of_character()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.vocabulary = Vocabulary.of([bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t in tokens])

    def __call__(self, texts: list[str]) -> Tokens:
        encoded = self.tokenizer.encode_batch([f" {t}" for t in texts], add_special_tokens=False)
        return _tokens([(e.ids, e.offsets) for e in encoded], 0)


class Pieces:
    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece has a blank behind another character")
        self.vocabulary = Vocabulary.of([bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

    def __call__(self, texts: list[str]) -> Tokens:
        encoded = self.model.encode(texts, return_type="offset_mapping", num_threads=1)
        tokens = _tokens([(e["ids"], e["offsets"]) for e in encoded], 1)
        first = tokens.first[:-1][np.diff(tokens.first) > 0]
        tokens.low[first] = 0  # the blank is in front of the library's text
        return tokens


def cut(tokens: Tokens, vocabulary: Vocabulary, byte_of: np.ndarray, char_first: np.ndarray) -> np.ndarray:
    """Byte after each token. ``byte_of`` maps characters of all texts to bytes, ``char_first`` texts to characters."""
    n = len(tokens.ids)
    if not n:
        return np.zeros(0, np.int64)
    counts = np.diff(tokens.first)
    text = np.repeat(np.arange(len(counts)), counts)
    low, high = tokens.low + char_first[text], tokens.high + char_first[text]
    coarse = np.zeros(n, bool)
    coarse[tokens.first[1:][counts > 0] - 1] = True
    coarse[:-1] |= (high[:-1] == low[1:]) & (high[:-1] > low[:-1])
    # Where the tokens between two coarse cuts begin, and their decoded bytes from there on.
    total = np.cumsum(vocabulary.size[tokens.ids])
    begins = np.concatenate(([True], coarse[:-1]))
    base = byte_of[low[begins]] - (total - vocabulary.size[tokens.ids])[begins]
    return np.where(coarse, byte_of[np.minimum(high, len(byte_of) - 1)], base[np.cumsum(begins) - 1] + total)


def checked(tokens: Tokens, ends: np.ndarray, vocabulary: Vocabulary, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts whose decoded bytes are the bytes given, and the ends; a text whose cuts contradict its decoded bytes
    is refined as a whole."""
    first = tokens.first
    total = np.concatenate(([0], np.cumsum(vocabulary.size[tokens.ids])))
    good = total[first[1:]] - total[first[:-1]] == np.diff(bounds)
    decoded = vocabulary.decoded(tokens.ids)
    for t in np.flatnonzero(good).tolist():
        good[t] = decoded[total[first[t]] : total[first[t + 1]]].tobytes() == raw[bounds[t] : bounds[t + 1]].tobytes()
    text = np.repeat(np.arange(len(good)), np.diff(first))
    exact = total[1:] - (total[first[:-1]] - bounds[:-1])[text]
    wrong = np.bincount(text[exact != ends], minlength=len(good)) > 0
    return good, np.where(wrong[text], exact, ends)


def _only(tokens: Tokens, ends: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends) of the tokens of good texts."""
    keep = np.repeat(good, np.diff(tokens.first))
    return tokens.ids[keep], ends[keep]


def summed(of: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of, pair, links) with each pair of a text or stretch once, in ascending order."""
    by = np.lexsort((pair, of))
    of, pair, links = of[by], pair[by], links[by]
    new = np.ones(len(pair), bool)
    new[1:] = (of[1:] != of[:-1]) | (pair[1:] != pair[:-1])
    head = np.flatnonzero(new)
    return of[head], pair[head], np.add.reduceat(links, head) if len(head) else links


class Aligner:
    def __init__(self, definition: str, model: bytes):
        self.a, self.b = ByteLevel(definition), Pieces(model)
        # Numbers with what follows them: "," inside a group, "|" after the last of A, ";" after the last of B.
        self.written = [[f"{i}{sign}" for i in range(n)] for n in (len(self.a.vocabulary.size), len(self.b.vocabulary.size)) for sign in ",;"]
        self.written[1] = [x[:-1] + "|" for x in self.written[1]]

    def __call__(self, texts: list[str]) -> tuple:
        """Per text n_a, n_b, n_groups, n_links, the groups as text, and (text, pair, links)."""
        # Empty texts have no tokens; A would see their blank.
        full = [k for k, t in enumerate(texts) if t]
        sizes = np.array([len(texts[k].encode()) + 1 for k in full], np.int64)
        *found, groups, of, pair, links = self._aligned([texts[k] for k in full], np.cumsum(sizes) - sizes)
        counts = np.zeros((4, len(texts)), np.int64)
        counts[:, full] = found
        written = [""] * len(texts)
        for k, g in zip(full, groups):
            written[k] = g
        return *counts, written, np.array(full, np.int64)[of], pair, links

    def of_stretches(self, parts: list[bytes]) -> tuple:
        """The same for stretches: a blank each, then no white space, which they do not end with either. They are
        put together to texts of about ``CHUNK_BYTES``."""
        sizes = np.array([len(x) for x in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        chunk = np.flatnonzero(np.diff(starts // CHUNK_BYTES, prepend=-1)).tolist()
        texts = [b"".join(parts[x:y])[1:].decode() for x, y in zip(chunk, [*chunk[1:], len(parts)])]
        return self._aligned(texts, starts)

    def _aligned(self, texts: list[str], units: np.ndarray) -> tuple:
        """Results per unit; ``units`` are the bytes at which they start, in the texts with their blanks put together."""
        raw = np.frombuffer("".join(f" {t}" for t in texts).encode(), np.uint8)
        byte_of = np.flatnonzero(np.append((raw & 0xC0) != 0x80, True))
        starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
        edges = byte_of[starts]
        sides = []
        for side in (self.a, self.b):
            tokens = side(texts)
            sides.append((tokens, *checked(tokens, cut(tokens, side.vocabulary, byte_of, starts[:-1]), side.vocabulary, raw, edges)))
        good = sides[0][1] & sides[1][1]
        (ids_a, end_a), (ids_b, end_b) = (_only(tokens, ends, good) for tokens, _, ends in sides)
        unit_a, unit_b = (np.searchsorted(units, end, side="left") - 1 for end in (end_a, end_b))
        n_a, n_b = (np.bincount(unit, minlength=len(units)) for unit in (unit_a, unit_b))

        ends = np.zeros(len(raw) + 1, bool)
        ends[end_b] = True
        closing_a = ends[end_a]
        ends[end_b] = False
        ends[end_a] = True
        closing_b = ends[end_b]
        n_groups = np.bincount(unit_a[closing_a], minlength=len(units))
        low_a = np.maximum(np.concatenate(([0], end_a[:-1]))[: len(end_a)], units[unit_a])
        low_b = np.maximum(np.concatenate(([0], end_b[:-1]))[: len(end_b)], units[unit_b])
        from_, to = np.searchsorted(end_b, low_a, side="right"), np.searchsorted(low_b, end_a, side="left")
        links = to - from_
        of = np.repeat(np.arange(len(ids_a)), links)
        other = np.arange(len(of)) - np.repeat(np.cumsum(links) - links - from_, links)
        n_links = np.bincount(unit_a[of], minlength=len(units))
        unit, pair, each = summed(unit_a[of], (ids_a[of] << SHIFT) | ids_b[other], np.ones(len(of), np.int64))
        return n_a, n_b, n_groups, n_links, self._written(ids_a, closing_a, n_a, ids_b, closing_b, n_b), unit, pair, each

    def _written(self, ids_a, closing_a, n_a, ids_b, closing_b, n_b) -> list[str]:
        group_a, group_b = np.cumsum(closing_a) - closing_a, np.cumsum(closing_b) - closing_b
        place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, side="left")
        place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")
        tokens = np.empty(len(ids_a) + len(ids_b), object)
        for place, ids, closing, (inside, last) in ((place_a, ids_a, closing_a, self.written[:2]), (place_b, ids_b, closing_b, self.written[2:])):
            tokens[place] = [last[i] if c else inside[i] for i, c in zip(ids.tolist(), closing.tolist())]
        edges = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        return ["".join(tokens[x:y])[:-1] for x, y in zip(edges[:-1], edges[1:])]


def _wide_spaces(data: np.ndarray) -> np.ndarray:
    """Last bytes of white space outside ASCII: U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000, and some signs."""
    one, two = np.concatenate(([0], data[:-1])), np.concatenate(([0, 0], data[:-2]))[: len(data)]
    found = (one == 0xC2) & ((data == 0x85) | (data == 0xA0))
    return found | ((two == 0xE2) & ((one == 0x80) | (one == 0x81))) | ((two == 0xE1) & (one == 0x9A)) | ((two == 0xE3) & (one == 0x80) & (data == 0x80))


def stretches(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts that are not empty, each with a blank in front, the borders of their stretches, and the
    stretch at which each text begins; empty texts have none."""
    sizes = np.diff(offsets)
    data = np.insert(raw[offsets[0] : offsets[-1]], offsets[:-1][sizes > 0] - offsets[0], np.uint8(32))
    starts = np.concatenate(([0], np.cumsum(sizes + (sizes > 0))))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    if len(data) and data.max() > 127:
        blank |= _wide_spaces(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[1 : len(data) - 1] = (data[1:-1] == 32) & ~blank[:-2] & ~blank[2:]
    cut[starts] = True
    borders = np.flatnonzero(cut)
    return data, borders, np.searchsorted(borders, starts)


class Kept:
    """Alignments of texts, put together from those of their stretches."""

    def __init__(self, align: Aligner):
        self.align = align
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.counts = np.zeros((0, 4), np.int64)
        self.groups: list[str] = []
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pair, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        """Align new stretches: ordinary ones many at a time, the others (and those not given back) one by one."""
        simple = [len(x) > 1 and not x[1:2].isspace() and x[-1] < 128 and not x[-1:].isspace() for x in new]
        some = [k for k, s in enumerate(simple) if s]
        if some:
            self._keep([new[k] for k in some], self.align.of_stretches([new[k] for k in some]))
        rest = [x for x, s in zip(new, simple) if not s] + [x for x in (new[k] for k in some) if not self.counts[self.known[x], 0]]
        if rest:
            self._keep(rest, self.align([x[1:].decode() for x in rest]))

    def _keep(self, new: list[bytes], found: tuple) -> None:
        *counts, groups, of, pair, links = found
        size = np.bincount(of, minlength=len(new))
        self.first = np.concatenate((self.first, len(self.pair) + np.cumsum(size) - size))
        self.size, self.counts = np.concatenate((self.size, size)), np.concatenate((self.counts, np.stack(counts, axis=1)))
        self.pair, self.links = np.concatenate((self.pair, pair)), np.concatenate((self.links, links))
        self.known.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.groups += groups

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple:
        """What ``Aligner`` gives for the texts between ``offsets``."""
        n = len(offsets) - 1
        data, borders, begins = stretches(raw, offsets)
        parts = pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(data)])
        encoded = parts.dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        self._learn([x for x in distinct if x not in self.known])
        slot = np.array([self.known[x] for x in distinct], np.int64)[encoded.indices.to_numpy(zero_copy_only=False)]
        text = np.repeat(np.arange(n), np.diff(begins))
        counts = np.stack([np.bincount(text, weights=self.counts[slot, k], minlength=n).astype(np.int64) for k in range(4)])
        bad = np.bincount(text[self.counts[slot, 0] == 0], minlength=n) > 0
        edges = begins.tolist()
        slots = slot.tolist()
        groups = [";".join([self.groups[k] for k in slots[x:y]]) for x, y in zip(edges[:-1], edges[1:])]

        # A stretch that a text holds several times gives its links once, with that weight.
        ours = ~bad[text]
        key, weight = np.unique(text[ours] * len(self.groups) + slot[ours], return_counts=True)
        own, kept = np.divmod(key, max(len(self.groups), 1))
        size = self.size[kept]
        of = np.repeat(np.arange(len(key)), size)
        at = np.arange(len(of)) + np.repeat(self.first[kept] - (np.cumsum(size) - size), size)
        of_text, pair, links = own[of], self.pair[at], self.links[at] * weight[of]
        # Texts one of whose stretches is not given back are aligned as a whole.
        if bad.any():
            whole = np.flatnonzero(bad)
            *more, written, of, pair_, links_ = self.align([raw[offsets[t] : offsets[t + 1]].tobytes().decode() for t in whole.tolist()])
            counts[:, whole] = np.stack(more)
            for t, g in zip(whole.tolist(), written):
                groups[t] = g
            of_text, pair, links = np.concatenate((of_text, whole[of])), np.concatenate((pair, pair_)), np.concatenate((links, links_))
        if len(self.known) > KEPT or any(len(x) > KEPT_BYTES for x in distinct):
            self._trim()
        return *counts, groups, *summed(of_text, pair, links)

    def _trim(self) -> None:
        """Forget long stretches, or all when there are too many."""
        if len(self.known) > KEPT:
            self._forget()
        else:
            self.known = {x: k for x, k in self.known.items() if len(x) <= KEPT_BYTES}


def _aligned(definition, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Kept(Aligner(definition.value, model.value))
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                lo, hi = int(lo), int(hi)
                *counts, groups, text, pair, links = align(raw, offsets[lo : hi + 1])
                pairs = pa.StructArray.from_arrays([pa.array(pair, pa.int64()), pa.array(links, pa.int32())], names=["pair", "links"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(hi - lo + 1)), pa.int32()), pairs)
                columns = [batch.column(0)[lo:hi], *(pa.array(c, pa.int64()) for c in counts), pa.array(groups, pa.string()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])

    return run


def token_alignment(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_a, n_b, n_groups, n_links, groups, pairs).

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of A and B of every group in order. ``pairs`` holds each linked id
    pair of the text once, with its number of links; ``pair`` is id of A * 2^32 + id of B.

    ``byte_level`` is the file of a byte-level BPE of the tokenizers library, ``pieces`` a sentencepiece model that
    adds a blank in front; both are read by the driver and broadcast (some 2 MB). Special tokens are plain text.

    Null and empty texts, and those the two tokenizers do not give back byte by byte, have no tokens, zeros and an
    empty text. Rows are independent: repeated and null ids stay as they are, an empty table gives an empty result,
    other columns are not read. Very long texts are encoded whole, one at a time.
    """
    context = docs.sparkSession.sparkContext
    with open(byte_level or byte_level_path(), encoding="utf-8") as file:
        definition = context.broadcast(file.read())
    with open(pieces or piece_path(), "rb") as file:
        model = context.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_aligned(definition, model)), RESULT)


def with_pair_counts(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` (stored rows with ``pairs`` and a unique ``row``) with n_best and count_sum in place of both.

    The count of an id pair is the number of rows that hold it linked. ``count_sum`` sums the counts over all links
    of a row, ``n_best`` the links whose count is the highest of their A id, ties included. Without links both are 0.
    """
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.links")
    counts = stored(links.groupBy("pair").agg(F.count("*").alias("n")), "pair_counts")
    own = F.shiftright("pair", SHIFT).cast("int")
    # One row per id of A: bounded by its vocabulary.
    best = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))
    rated = stored(counts.join(F.broadcast(best), own == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair_rates")
    total = rated.agg(F.sum("n")).first()[0] or 0
    head = rated.where(F.col("n") * frequent >= total)
    found = links.join(F.broadcast(head), "pair", "left")
    value = [F.sum(F.col("n") * F.col("links")).alias("s"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("b")]
    often = found.where("n is not null").groupBy("row").agg(*value)
    rest = found.where("n is null").select("row", "pair", "links").join(rated.where(F.col("n") * frequent < total), "pair").groupBy("row").agg(*value)
    sums = often.unionByName(rest).groupBy("row").agg(F.sum("s").alias("s"), F.sum("b").alias("b")).withColumnRenamed("row", "own_row")
    joined = aligned.drop("pairs").join(sums, F.col("row") == F.col("own_row"), "left")
    return joined.withColumns({"n_best": F.coalesce("b", F.lit(0)).cast("long"), "count_sum": F.coalesce("s", F.lit(0)).cast("long")}).drop("row", "own_row", "s", "b")


def alignment_report(aligned: DataFrame) -> DataFrame:
    """Digest columns of ``token_alignment``, with the corpus-wide counts of the pairs."""
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = aligned.withColumns({"groups_sha256": digest, "row": F.monotonically_increasing_id()}).drop("groups")
    counted = with_pair_counts(stored(rows, "alignment"))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
