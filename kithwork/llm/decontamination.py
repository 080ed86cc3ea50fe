"""Benchmark decontamination by greedy string tiling of documents and benchmark items.

A document is read against the benchmark in three steps, in one pass over the text:

1. Seeds: the rolling hash of every ``MIN_MATCH`` tokens of the document is looked up among the seeds of
   the items. Only items that share a seed are compared.
2. Running Karp-Rabin greedy string tiling: seed matches are extended to maximal matches, and the longest
   ones whose tokens are unmarked on both sides become tiles, again and again, until none of at least
   ``MIN_MATCH`` tokens is left. Tiles may come in any order, so reordered passages are found.
3. Coverage: the share of the item's tokens under tiles. At ``THRESHOLD`` or more the document is
   contaminated by the item.

The benchmark goes to the tasks in blocks of at most ``BLOCK_TOKENS`` tokens, each with a pass over the
documents, so what is broadcast is bounded however large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.tables import stored
from kithwork.llm.words import BASE, Hasher, column_bytes, lean, mix, slices

MIN_MATCH = 5
THRESHOLD = 0.5
BLOCK_TOKENS = 2_000_000
# Pairs of places with the same seed looked at together.
SEED_PAIRS = 1 << 20

# Token characters: ASCII letters and digits, and every byte of a longer UTF-8 sequence.
SEPARATOR = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def seed_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` tokens."""
    n = len(tokens) - length + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(length if n > 0 else 0):
        rolled = (rolled + tokens[k : n + k]) * np.uint64(BASE)
    return mix(rolled)


def tiles(n_pattern: int, n_text: int, runs: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (pattern start, text start, length) of the tiles.

    ``runs`` are the maximal matches (length, pattern start, text start). Matches are taken longest first, ties
    by pattern start, then text start; a match that is partly marked meanwhile is cut to what is free. It ends
    where no ``least`` tokens of the pattern in a row are free.
    """
    free_p, free_t = np.ones(n_pattern, bool), np.ones(n_text, bool)
    out = []
    while runs and _longest_true(free_p) >= least:
        longest = max(r[0] for r in runs)
        rest = []
        for length, p, t in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
            if length < longest:
                rest.append((length, p, t))
                continue
            free = free_p[p : p + length] & free_t[t : t + length]
            if free.all():
                free_p[p : p + length] = free_t[t : t + length] = False
                out.append((p, t, length))
                if _longest_true(free_p) < least:
                    break
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
            rest += [(int(b - a), p + int(a), t + int(a)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= least]
        runs = rest
    return out


def _longest_true(flags: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return int((edges[1::2] - edges[::2]).max()) if len(edges) else 0


class Index:
    """Tokens and seeds of a block of benchmark items, as arrays."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        raw, offsets = column_bytes(pa.array([text for _, text in items], pa.string()))
        words = Hasher().words(raw, offsets, np.arange(256, dtype=np.uint8), SEPARATOR)
        self.ids = [item for item, _ in items]
        self.tokens, self.first, self.size = words.hashes, words.first[:-1], np.diff(words.first)
        self.least = np.minimum(self.size, least)  # tokens of a seed of the item
        seeds, item, at = [], [], []
        for number, (start, n, length) in enumerate(zip(self.first.tolist(), self.size.tolist(), self.least.tolist())):
            own = seed_hashes(self.tokens[start : start + n], max(length, 1))
            seeds.append(own)
            item.append(np.full(len(own), number, np.int32))
            at.append(np.arange(len(own), dtype=np.int32))
        seeds, item, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seeds, item, at))
        order = np.lexsort((at, item, seeds))
        self.seeds, self.item, self.at = seeds[order].astype(np.uint64), item[order], at[order]
        self.lengths = sorted(set(self.least[self.least > 0].tolist()))

    def runs(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(item, start in it, start in ``tokens``, length) of the maximal matches of at least a seed.

        Shared seeds are looked at ``SEED_PAIRS`` at a time, and only those that begin a match are kept: where the
        tokens before are equal too, the match began earlier.
        """
        found = [np.zeros((3, 0), np.int64)]
        for length in self.lengths:
            seeds = seed_hashes(tokens, length)
            low = np.searchsorted(self.seeds, seeds)
            hit = np.flatnonzero(self.seeds[np.minimum(low, len(self.seeds) - 1)] == seeds)
            if not len(hit):
                continue
            low = low[hit]
            count = np.searchsorted(self.seeds, seeds[hit], side="right") - low
            total = np.cumsum(count)
            while len(hit):
                some = max(1, int(np.searchsorted(total, SEED_PAIRS, side="right")))
                n = count[:some]
                t = np.repeat(hit[:some], n)
                k = np.arange(len(t)) + np.repeat(low[:some] - (np.cumsum(n) - n), n)
                hit, low, count, total = hit[some:], low[some:], count[some:], total[some:] - total[some - 1]
                item, p = self.item[k].astype(np.int64), self.at[k].astype(np.int64)
                inner = (p > 0) & (t > 0)
                before = self.tokens[self.first[item] + p - inner] == tokens[t - inner]
                begins = (self.least[item] == length) & ~(inner & before)
                found.append(np.stack((item[begins], p[begins], t[begins])))
        item, p, t = np.concatenate(found, axis=1)
        n = self.least[item].astype(np.int64)
        growing = np.arange(len(item))
        while len(growing):
            i, at, to = item[growing], p[growing] + n[growing], t[growing] + n[growing]
            inside = (at < self.size[i]) & (to < len(tokens))
            growing, i, at, to = growing[inside], i[inside], at[inside], to[inside]
            growing = growing[self.tokens[self.first[i] + at] == tokens[to]]
            n[growing] += 1
        return item, p, t, n


def _covered(index: Index, least: int, threshold: float):
    def document(tokens: np.ndarray) -> list[tuple[int, float, int]]:
        item, p, t, n = index.runs(tokens)
        order = np.argsort(item, kind="stable")
        out = []
        for own in np.split(order, np.flatnonzero(np.diff(item[order])) + 1) if len(order) else []:
            i = int(item[own[0]])
            size = int(index.size[i])
            change = np.zeros(size + 1, np.int64)
            np.add.at(change, p[own], 1)
            np.add.at(change, p[own] + n[own], -1)
            if np.count_nonzero(np.cumsum(change[:-1])) < threshold * size:
                continue  # even all matches together leave too much uncovered
            runs = list(zip(n[own].tolist(), p[own].tolist(), t[own].tolist()))
            covered = sum(length for _, _, length in tiles(size, len(tokens), runs, int(index.least[i])))
            if covered >= threshold * size:
                out.append((index.ids[i], covered / size, covered))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, offsets = column_bytes(batch.column(1))
            rows = []
            for a, b in slices(offsets):
                words = hasher.words(raw, offsets[a : b + 1], np.arange(256, dtype=np.uint8), SEPARATOR)
                for d in range(b - a):
                    rows += [(ids[a + d], *found) for found in document(words.hashes[words.first[d] : words.first[d + 1]])]
            columns = list(zip(*rows)) or [[], [], [], []]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "coverage", "n_tokens"])

    return run


def benchmark_blocks(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; a longer item is a block of its own. Items without text or id are none."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.col("text").cast("string")).alias("text"))
    items = items.where("item_id is not null and text is not null").distinct().orderBy("item_id", "text")
    block, size = [], 0
    for row in items.toLocalIterator():
        n = len(row["text"]) // 2 + 1
        if block and size + n > block_tokens:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += n
    if block:
        yield block


def contaminations(docs: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, coverage, n_tokens): every document and item with coverage at or above ``threshold``.

    Tokens are runs of letters, digits and non-ASCII characters of the lower-cased text; an item of fewer
    than ``least`` tokens must match as a whole. Items without tokens match nothing. Null and empty texts
    have no row. Repeated rows give repeated rows. Other columns are not read. A very long text is read whole; what
    is held of it are its tokens and the matches with the items, each of which is one entry however long it is.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    texts = texts.where(F.col("text") != "")
    schema = "doc_id long, item_id long, coverage double, n_tokens long"
    found = []
    for block in benchmark_blocks(benchmark):
        index = Index(block, least)
        if len(index.seeds):
            found.append(stored(texts.mapInArrow(lean(_covered(index, least, threshold)), schema), "contaminations"))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` with an id: (doc_id, contaminated, item_id, coverage, n_items).

    ``item_id`` and ``coverage`` are those of the best covered item, ties by smaller id; null and 0 for
    clean documents. Rows with a null doc_id have no row; repeated rows have one each. An empty benchmark
    leaves every document clean, an empty table gives an empty result.
    """
    links = contaminations(docs, benchmark, least, threshold)
    best = F.max_by("item_id", F.struct("coverage", -F.col("item_id")))
    hits = links.groupBy("doc_id").agg(best.alias("item_id"), F.max("coverage").alias("coverage"), F.countDistinct("item_id").alias("n_items"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    return ids.join(hits, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
    )
