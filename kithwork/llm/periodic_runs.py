"""Periodic runs of words, found with an enhanced suffix array and the branching-tandem test.

The words of a slice of texts are ranked by prefix doubling, every text for itself: the first rank of a word
holds its text, so no two suffixes of different texts are ever tied, and a text border ends every match. The
ranks of all rounds are kept; equal ranks of a round mean equal stretches of that many words.

1. The suffix array is the last ranking, its LCP values come from the kept rounds.
2. For each LCP interval of depth d all suffixes but those of its largest child are looked at: a suffix i with
   i + d (or i - d) elsewhere in the interval starts (or continues) a square of two times d words that cannot
   be moved to the right, a branching tandem. No tree is built: intervals are borders in the array.
3. Every such square is rotated to the left as far as the words agree, by the kept rounds; start and end of
   the stretch make the run. Squares with the same stretch are one run, of the smallest period.

A run of at least m words and period q also shows as a square of k * q words with m / 4 < k * q <= length / 2,
so LCP intervals of depth up to m / 4 are not needed, and only suffixes with a longer repeat are sorted on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.words import GAP, column_bytes, slices

LEAST_WORDS = 12
RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


class Text(NamedTuple):
    """Words of the texts of a slice: ``first[t]`` to ``first[t + 1]`` belong to text t."""

    ids: np.ndarray  # equal words of the slice have equal numbers
    first: np.ndarray
    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    data: np.ndarray


class Runs(NamedTuple):
    start: np.ndarray  # word numbers within the slice
    length: np.ndarray
    period: np.ndarray


def split_words(raw: np.ndarray, offsets: np.ndarray) -> Text:
    data = raw[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    border = np.zeros(len(data) + 1, bool)
    border[bounds] = True
    letter = ~GAP[data]
    inside = np.concatenate(([False], letter, [False]))
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    edges = np.concatenate(([0], np.cumsum(end - start)))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data[letter])])
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(start) else np.zeros(0, np.int64)
    return Text(ids, np.searchsorted(start, bounds), start, end, data)


def first_of_groups(*keys: np.ndarray) -> np.ndarray:
    """For ascending rows of ``keys`` the position of the first equal row."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def repeated(first: np.ndarray) -> np.ndarray:
    """Whether the group of each row has more than one row."""
    size = np.bincount(first, minlength=len(first))
    return size[first] > 1


def rankings(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4 .. symbols from every position on, until all differ.

    A rank is the number of positions with smaller symbols, so the last ranking is the inverse suffix array.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = first_of_groups(ids[order])
    rank = np.empty(n, np.int64)
    rank[order] = first
    tied = order[repeated(first)]
    levels, h = [rank], 1
    while len(tied):
        following = tied + h
        second = np.where(following < n, rank[np.minimum(following, n - 1)], -1)
        own = rank[tied]
        by = np.lexsort((second, own))
        tied, own, second = tied[by], own[by], second[by]
        first = first_of_groups(own, second)
        rank = rank.copy()
        rank[tied] = own + first - first_of_groups(own)
        tied = tied[repeated(first)]
        levels.append(rank)
        h *= 2
    return levels


def common_right(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols agree from positions a and b on; a < b."""
    n, at, to = len(levels[0]), a.copy(), b.copy()
    for k in range(len(levels) - 2, -1, -1):
        inside = to + (1 << k) <= n
        same = inside & (levels[k][np.minimum(at, n - 1)] == levels[k][np.minimum(to, n - 1)])
        at[same] += 1 << k
        to[same] += 1 << k
    return at - a


def common_left(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols agree right before positions a and b; a < b."""
    at = a.copy()
    for k in range(len(levels) - 2, -1, -1):
        back = at - (1 << k)
        same = (back >= 0) & (levels[k][np.maximum(back, 0)] == levels[k][np.maximum(back, 0) + b - a])
        at[same] = back[same]
    return a - at


def lcp_intervals(lcp: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(border, left, right): for every border of at least ``depth`` the interval it lies in, both ends included.

    ``lcp[k]`` belongs to the suffixes k - 1 and k of the array.
    """
    left, right, open_ = [0] * len(lcp), [len(lcp) - 1] * len(lcp), []
    for k, value in enumerate(lcp.tolist()):
        while open_ and open_[-1][0] > value:
            right[open_.pop()[1]] = k - 1
        # A border of the same depth keeps the interval open.
        if open_ and open_[-1][0] == value:
            left[k] = left[open_[-1][1]]
        else:
            left[k] = open_[-1][1] if open_ else 0
        open_.append((value, k))
    border = np.flatnonzero(lcp >= depth)
    return border, np.array(left, np.int64)[border], np.array(right, np.int64)[border]


def small_children(lcp: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(left, right, d, child left, child right) of all children but the largest of every LCP interval."""
    border, left, right = lcp_intervals(lcp, depth)
    d = lcp[border]
    by = np.lexsort((border, d, left))
    border, left, right, d = border[by], left[by], right[by], d[by]
    of = np.cumsum(np.concatenate(([True], (left[1:] != left[:-1]) | (d[1:] != d[:-1])))) - 1 if len(border) else np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else of
    starts = np.concatenate((left[head], border))
    owner = np.concatenate((np.arange(len(head)), of))
    by = np.lexsort((starts, owner))
    starts, owner = starts[by], owner[by]
    last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    ends = np.where(last, right[head][owner], np.append(starts[1:], 0)[: len(starts)] - 1)
    by = np.lexsort((starts - ends, owner))  # largest child first
    small = by[first_of_groups(owner[by]) != np.arange(len(by))] if len(by) else by
    owner = owner[small]
    return left[head][owner], right[head][owner], d[head][owner], starts[small], ends[small]


def find_runs(levels: list[np.ndarray], least: int) -> Runs:
    """All runs of at least ``least`` symbols (and two periods) of a ranked sequence."""
    depth = least // 4 + 1
    none = Runs(*(np.zeros(0, np.int64),) * 3)
    level = min(depth.bit_length() - 1, len(levels) - 1)
    coarse, rank = levels[level], levels[-1]
    suffix = np.empty(len(rank), np.int64)
    suffix[rank] = np.arange(len(rank))
    suffix = suffix[np.bincount(coarse, minlength=len(coarse))[coarse[suffix]] > 1]
    if not len(suffix):
        return none
    place = np.full(len(rank), -1, np.int64)
    place[suffix] = np.arange(len(suffix))
    lcp = np.zeros(len(suffix), np.int64)
    tied = np.flatnonzero(coarse[suffix[1:]] == coarse[suffix[:-1]]) + 1
    a, b = suffix[tied - 1], suffix[tied]
    lcp[tied] = common_right(levels, np.minimum(a, b), np.maximum(a, b))
    left, right, d, low, high = small_children(lcp, depth)
    size = high - low + 1
    ends = np.cumsum(size)
    of = np.repeat(np.arange(len(size)), size)
    i = suffix[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size - low, size)]
    left, right, d, low, high = left[of], right[of], d[of], low[of], high[of]
    squares = []
    for other, begin in ((i + d, i), (i - d, i - d)):
        inside = (other >= 0) & (other < len(rank))
        at = place[np.where(inside, other, 0)]
        hit = inside & (at >= left) & (at <= right) & ((at < low) | (at > high))
        squares.append((begin[hit], d[hit]))
    begin, d = (np.concatenate(x) for x in zip(*squares))
    start = begin - common_left(levels, begin, begin + d)
    end = begin + 2 * d
    by = np.lexsort((d, end, start))
    start, end, d = start[by], end[by], d[by]
    if not len(start):
        return none
    one = first_of_groups(start, end) == np.arange(len(start))
    start, length, period = start[one], (end - start)[one], d[one].copy()
    # Periods up to a quarter of the least length show as multiples only.
    for q in range(depth - 1, 0, -1):
        whole = np.flatnonzero(period % q == 0)
        shorter = whole[common_right(levels, start[whole], start[whole] + q) >= length[whole] - q]
        period[shorter] = q
    long = length >= np.maximum(least, 2 * period)
    return Runs(start[long], length[long], period[long])


def runs_of_texts(text: Text, least: int) -> tuple[Runs, np.ndarray]:
    """The runs of all texts of a slice by start, then period, and the text of each."""
    counts = np.diff(text.first)
    of = np.repeat(np.arange(len(counts)), counts)
    n_ids = int(text.ids.max()) + 1 if len(text.ids) else 1
    runs = find_runs(rankings(of * n_ids + text.ids), least) if len(of) else Runs(*(np.zeros(0, np.int64),) * 3)
    by = np.lexsort((runs.period, runs.start))
    runs = Runs(*(x[by] for x in runs))
    return runs, of[runs.start]


def kept_words(runs: Runs, n: int) -> np.ndarray:
    """Which words are in no run, or in the first period of each run that holds them."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    return np.cumsum(change[:-1]) == 0


def joined(text: Text, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all texts, joined by one blank, and the offset where each text starts."""
    word = np.flatnonzero(kept)
    first = np.searchsorted(word, text.first)
    size = text.end[word] - text.start[word] + 1
    closing = first[1:][first[1:] > first[:-1]] - 1  # the last word of a text has no blank behind it
    size[closing] -= 1
    ends = np.cumsum(size)
    offsets = np.concatenate(([0], ends))
    source = np.arange(int(offsets[-1])) + np.repeat(text.start[word] - (ends - size), size)
    out = np.append(text.data, np.uint8(32))[source]
    blank = np.ones(len(word), bool)
    blank[closing] = False
    out[ends[blank] - 1] = 32
    return out, offsets[first]


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                text = split_words(raw, offsets[lo : hi + 1])
                runs, of = runs_of_texts(text, least)
                out, starts = joined(text, kept_words(runs, len(text.ids)))
                fields = [runs.start - text.first[of], runs.length, runs.period]
                spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in fields], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(hi - lo + 1)), pa.int32()), spans)
                texts = pa.Array.from_buffers(pa.large_string(), int(hi - lo), [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(out)])
                columns = [batch.column(0)[lo:hi], pa.array(np.diff(text.first), pa.int64()), lists, texts.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "text"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, runs, text).

    ``runs`` holds (start, length, period) in words of every stretch with smallest period q and at least
    max(``least``, 2 * q) words that neither neighbour extends, by start, then period. ``text`` has the words
    that are left when of each run only the first period stays, joined by one blank. Words are case-sensitive.

    Null and empty texts have no words, no runs and an empty text. Rows are independent of each other: repeated
    and null ids are kept as they are, an empty table gives an empty result, other columns are not read. Very
    long texts are worked on whole; the arrays of a text take about 20 times 8 bytes a word and round.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_runs(least), RESULT)


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with runs planted in the texts of a tenth of the ids, as the registered query asks for.

    With h the crc32 of the id, g = h div 10 and n words: where h mod 10 is 0 every word i from a = g mod n on
    becomes word a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    g = F.expr("_h div 10")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("_h"))
    rows = rows.withColumn("_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    n = F.size("_words")
    rows = rows.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", F.expr("1 + (size(_words) - _a) div (3 + (_h div 10) % 8)"))
    source = F.transform(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")), lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")))
    words = F.transform(source, lambda i: F.get("_words", i.cast("int")))
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """Digest columns of ``periodic_runs``: the number of runs, the longest, and sha256 of runs and text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.array_join(lines, "").alias("lines"), "text")
    return rows.select(
        "doc_id", "n_runs", F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
        F.expr("(-b.l * 1000) div b.p").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
