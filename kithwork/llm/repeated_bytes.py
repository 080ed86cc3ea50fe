"""Suffix-array dedup: bytes of 100-byte strings that occur earlier in the corpus are removed.

No task sees the corpus as a whole, so equal windows of ``least`` bytes are first brought together:

1. The key of a window is the smallest hash of its ``GRAM``-byte strings, so equal windows have equal keys. A
   segment is a longest stretch of consecutive windows with one key, about (least - GRAM) / 2 windows, and is
   described by its key and a digest of its bytes.
2. Keys of a single segment without inner repeats cannot hold a repeated window. Of the others, equal segments
   are merged: all windows of the later copies repeat the first one, which stands for them in step 3.
3. The first copies that share a key with a different segment, or repeat a string of their own key, go to the
   task of their key with their bytes, in blocks of whole keys of about ``BLOCK_BYTES``. In each block the
   Burrows-Wheeler transform is expanded: from the interval of the empty string on, breadth first, every
   interval of a string w is extended to those of c w; the right border of a new interval of a string of l + 1
   bytes has the common prefix l unless it is known already. It stops at ``least``: borders still without a
   value have a common prefix of at least that, and the suffixes between other borders start with equal windows.
   The window with the smallest (doc_id, start) stays, the others are repeats.
4. Keys with more than ``BLOCK_BYTES`` of different segments are too large for a task. Their segments are cut again
   by keys of strings that are only ``FINE`` bytes shorter than a window, and go through 2 and 3 once more. What is
   too large even then is dealt out window by window by a digest of two 64-bit hashes, partially aggregated.

Repeated windows are joined to spans per document, and one pass over the documents cuts them out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.periodic_runs import first_of_groups, repeated
from kithwork.llm.tables import matching_rows, stored
from kithwork.llm.words import Hasher, column_bytes, slices

LEAST_BYTES = 100
GRAM = 24
FINE = 12
BLOCK_BYTES = 1 << 19
SEGMENTS = "doc_id long, start int, mark int, n int, inner boolean, key long, digest long"
PLACED = "doc_id long, start int, mark int, n int, key long, bytes binary"
FINER = "doc_id long, start int, mark int, n int, inner boolean, key long, digest long, bytes binary"
REPEATS = "doc_id long, start int, mark int, n int"
WINDOWS = "doc_id long, start int, mark int, h1 long, h2 long"
RESULT = "doc_id long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary"
OTHER_BASE = 0xD6E8FEB86659FD93


def _sliding(values: np.ndarray, width: int, ufunc: np.ufunc) -> np.ndarray:
    """``ufunc`` (minimum or maximum) over every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    rows = np.concatenate((values, np.repeat(values[-1:], -len(values) % width))).reshape(-1, width)
    ahead = ufunc.accumulate(rows, axis=1).ravel()
    behind = ufunc.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(behind[:n], ahead[width - 1 : width - 1 + n])


class Segmenter:
    """Segments of texts: (text, start, windows, inner, key, digest)."""

    def __init__(self, least: int, gram: int = GRAM):
        self.least, self.gram = least, min(gram, least)
        self.hasher = Hasher()

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        data = raw[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        width = self.least - self.gram + 1
        if len(data) < self.least:
            return (np.zeros(0, np.int64),) * 6
        grams = np.arange(len(data) - self.gram + 1)
        hashes = self.hasher.spans(data, grams, grams + self.gram)
        keys = _sliding(hashes, width, np.minimum)
        # A window is one of a text if it ends where the text does or before.
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(keys)]
        valid = np.arange(len(keys)) + self.least <= bounds[1:][text]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
        start = np.flatnonzero(new)
        n = np.diff(np.append(start, len(keys)))
        start, n = start[valid[start]], n[valid[start]]
        key = keys[start]
        # Strings that are the smallest of some window, and how many of a segment's key each segment holds.
        padded = np.concatenate((np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)))
        chosen = np.flatnonzero(hashes == _sliding(padded, width, np.maximum))
        low, high = np.searchsorted(chosen, start), np.searchsorted(chosen, start + n + width - 1)
        of = np.repeat(np.arange(len(start)), high - low)
        at = chosen[np.arange(len(of)) - np.repeat(np.cumsum(high - low) - high, high - low)]
        inner = np.bincount(of[hashes[at] == key[of]], minlength=len(start)) > 1
        stop = start + n + self.least - 1
        digest = self.hasher.spans(data, start, stop)
        return text[start], start - bounds[text[start]], n, inner, key, digest


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for name in names]


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.astype(np.uint64).view(np.int64))


def _segments(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Segmenter(least)
        for batch in batches:
            ids, marks = _columns(batch, "doc_id", "mark")
            raw, offsets = column_bytes(batch.column(batch.schema.get_field_index("text")))
            for lo, hi in slices(offsets):
                text, start, n, inner, key, digest = cut(raw, offsets[lo : hi + 1])
                columns = [pa.array(ids[lo + text], pa.int64()), pa.array(start, pa.int32()), pa.array(marks[lo + text], pa.int32()), pa.array(n, pa.int32())]
                columns += [pa.array(inner.astype(bool)), _signed(key), _signed(digest)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "mark", "n", "inner", "key", "digest"])

    return run


def _with_bytes(least: int):
    """Rows (doc_id, mark, text, segments) to one row per segment, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = _columns(batch, "doc_id", "mark")
            raw, offsets = column_bytes(batch.column(batch.schema.get_field_index("text")))
            lists = batch.column(batch.schema.get_field_index("segments"))
            own = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            start, n, key = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            for k in range(0, len(own), 4096):
                some = slice(k, k + 4096)
                low = offsets[own[some]] + start[some]
                parts = [raw[a:b].tobytes() for a, b in zip(low.tolist(), (low + n[some] + least - 1).tolist())]
                columns = [pa.array(ids[own[some]], pa.int64()), pa.array(start[some]), pa.array(marks[own[some]], pa.int32()), pa.array(n[some]), pa.array(key[some]), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "mark", "n", "key", "bytes"])

    return run


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions by at least their first ``depth`` symbols (bytes; 0 ends a segment and counts as smallest)."""
    n = len(symbols)
    padded = np.concatenate((symbols, np.zeros(8, symbols.dtype))).astype(np.uint64)
    first = np.zeros(n, np.uint64)
    for k in range(7):
        # 257 symbols do not fit into 8 bits: seven symbols of 9 bits a number.
        first = (first << np.uint64(9)) | padded[k : k + n]
    order = np.argsort(first, kind="stable")
    group = first_of_groups(first[order])
    rank = np.empty(n, np.int64)
    rank[order] = group
    tied, h = order[repeated(group)], 7
    while h < depth and len(tied):
        following = tied + h
        second = np.where(following < n, rank[np.minimum(following, n - 1)], -1)
        own = rank[tied]
        by = np.lexsort((second, own))
        tied, own, second = tied[by], own[by], second[by]
        group, whole = first_of_groups(own, second), first_of_groups(own)
        order[own + np.arange(len(tied)) - whole] = tied
        rank[tied] = own + group - whole
        tied = tied[repeated(group)]
        h *= 2
    return order


def equal_prefixes(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Group of every place of the suffix order: places of a group agree in ``least`` symbols.

    ``symbols`` ends with 0 and is read as a circle. Only the Burrows-Wheeler transform is used: breadth-first
    backward extension of intervals gives the common prefixes below ``least`` by increasing value.
    """
    n = len(symbols)
    bwt = symbols[order - 1].astype(np.int64)
    by = np.argsort(bwt, kind="stable")  # places of the transform by symbol: their number is the last-to-first map
    to_first = np.empty(n, np.int64)
    to_first[by] = np.arange(n)
    following = np.full(n, n, np.int64)  # next place with the same symbol
    same = np.flatnonzero(bwt[by[1:]] == bwt[by[:-1]])
    following[by[same]] = by[same + 1]
    keys = bwt[by] * n + by
    known = np.zeros(n + 1, bool)  # border before this place
    known[0] = known[n] = True
    left, right = np.array([0]), np.array([n - 1])
    for _ in range(least):
        if not len(left):
            break
        size = right - left + 1
        of = np.repeat(np.arange(len(left)), size)
        place = np.arange(len(of)) + np.repeat(left - (np.cumsum(size) - size), size)
        # The last place of each symbol in an interval ends the interval of the longer string.
        last = following[place] > right[of]
        place, of = place[last], of[last]
        end = to_first[place]
        new = ~known[end + 1]
        place, of, end = place[new], of[new], end[new]
        known[end + 1] = True
        left, right = np.searchsorted(keys, bwt[place] * n + left[of]), end
    return np.cumsum(known[:-1]) - 1


def repeated_windows(parts: list[bytes], places: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset), ascending, of all windows that are not the first of their string.

    ``places`` are doc_id, start and mark of the segments; windows rank by doc_id, start in the text, mark.
    """
    doc, start, mark = places
    sizes = np.array([len(p) for p in parts], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.uint16)
    inside = np.ones(len(symbols), bool)
    inside[first + sizes] = False
    symbols[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 1
    order = suffix_order(symbols, least)
    group = equal_prefixes(symbols, order, least)
    of = np.repeat(np.arange(len(parts)), sizes + 1)[order]
    offset = order - first[of]
    window = np.flatnonzero((offset + least <= sizes[of]) & (np.bincount(group)[group] > 1))
    group, of, offset = group[window], of[window], offset[window]
    by = np.lexsort((mark[of], start[of] + offset, doc[of], group))
    group, of, offset = group[by], of[by], offset[by]
    head = first_of_groups(group)
    # Rows that repeat a document give the same place again.
    place = (doc[of], start[of] + offset, mark[of])
    later = np.flatnonzero(np.logical_or.reduce([x != x[head] for x in place]) if len(of) else np.zeros(0, bool))
    by = later[np.lexsort((offset[later], of[later]))]
    return of[by], offset[by]


def _repeats(of: np.ndarray, offset: np.ndarray, places: list[np.ndarray]) -> pa.RecordBatch:
    """Consecutive windows of a segment as one row."""
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (offset[1:] != offset[:-1] + 1)
    head = np.flatnonzero(new)
    doc, start, mark = (x[of[head]] for x in places)
    columns = [pa.array(doc, pa.int64()), pa.array(start + offset[head], pa.int32()), pa.array(mark, pa.int32()), pa.array(np.diff(np.append(head, len(of))), pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "mark", "n"])


def _blocks(least: int, block: int):
    """Rows of a partition, sorted by key, to the repeated windows in blocks of whole keys."""

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if held:
            places = [np.concatenate([h[k] for h in held]) for k in range(3)]
            yield _repeats(*repeated_windows([p for h in held for p in h[3]], places, least), places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            *places, key = _columns(batch, "doc_id", "start", "mark", "key")
            parts = batch.column(batch.schema.get_field_index("bytes")).to_pylist()
            borders = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else []
            for a, b in zip(borders, [*borders[1:], len(key)]):
                if size >= block and key[a] != last:
                    yield from flush(held)
                    held, size = [], 0
                held.append((*(p[a:b].astype(np.int64) for p in places), parts[a:b]))
                size, last = size + sum(map(len, parts[a:b])), key[a]
        yield from flush(held)

    return run


def _some(batch: pa.RecordBatch) -> Iterator[tuple[list[np.ndarray], list[bytes]]]:
    """Places (doc_id, start, mark), windows and bytes of some rows of a batch at a time."""
    columns = _columns(batch, "doc_id", "start", "mark", "n")
    parts = batch.column(batch.schema.get_field_index("bytes")).to_pylist()
    for k in range(0, len(parts), 1024):
        yield [c[k : k + 1024] for c in columns], parts[k : k + 1024]


def _finer(least: int):
    """Segments with bytes to segments of longer keys, with bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Segmenter(least, max(GRAM, least - FINE))
        for (doc, start, mark, _), parts in (x for batch in batches for x in _some(batch)):
            raw, offsets = np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            of, at, n, inner, key, digest = cut(raw, offsets)
            pieces = [parts[k][a : a + m] for k, a, m in zip(of.tolist(), at.tolist(), (n + least - 1).tolist())]
            columns = [pa.array(doc[of], pa.int64()), pa.array(start[of] + at, pa.int32()), pa.array(mark[of], pa.int32()), pa.array(n, pa.int32())]
            columns += [pa.array(inner.astype(bool)), _signed(key), _signed(digest), pa.array(pieces, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "mark", "n", "inner", "key", "digest", "bytes"])

    return run


def _windows(least: int):
    """Segments with bytes to one row per window, with two hashes of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = [Hasher(), Hasher(OTHER_BASE)]
        for (doc, start, mark, n), parts in (x for batch in batches for x in _some(batch)):
            raw, count = np.frombuffer(b"".join(parts), np.uint8), n.astype(np.int64)
            of = np.repeat(np.arange(len(count)), count)
            offset = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(np.cumsum(count + least - 1) - (count + least - 1), count) + offset
            columns = [pa.array(doc[of], pa.int64()), pa.array(start[of] + offset, pa.int32()), pa.array(mark[of], pa.int32())]
            columns += [_signed(h.spans(raw, at, at + least)) for h in hashers]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "mark", "h1", "h2"])

    return run


def later_copies(rows: DataFrame, keys: list[str], firsts: DataFrame) -> DataFrame:
    """The rows whose place is not the ``first`` one of their keys."""
    place = [F.col(x) != F.col(f"first.{x}") for x in ("doc_id", "start", "mark")]
    return rows.join(firsts, keys).where(place[0] | place[1] | place[2])


def repeated_strings(docs: DataFrame, least: int = LEAST_BYTES, block: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, start, mark, n): n consecutive windows of ``least`` bytes from byte ``start`` on that occur earlier.

    ``docs`` has doc_id, text and ``mark``, a hash of the text that tells rows of one doc_id apart.
    """
    place = F.struct("doc_id", "start", "mark")
    texts = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= least)).select("doc_id", "mark", "text")
    segments = stored(texts.mapInArrow(_segments(least), SEGMENTS), "segments")
    shared = segments.groupBy("key").agg(F.count("*").alias("c"), F.max("inner").alias("i")).where("c > 1 or i").select("key")
    segments = matching_rows(segments, shared, "key", "shared_segments")
    distinct = segments.groupBy("key", "digest").agg(F.min(place).alias("first"), F.max("n").alias("n"), F.max("inner").alias("inner"), F.count("*").alias("c"))
    distinct = stored(distinct, "distinct_segments")
    copies = later_copies(segments, ["key", "digest"], distinct.where("c > 1").select("key", "digest", "first"))

    wanted = distinct.select("key", "first.*", "n").join(shared_keys(distinct, least), "key")
    # One list per text, of its own segments only.
    lists = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "n", "key")).alias("segments"))
    first = stored(texts.join(lists, ["doc_id", "mark"]).select("doc_id", "mark", "text", "segments").mapInArrow(_with_bytes(least), PLACED), "segment_bytes")
    expanded, first = in_blocks(first, shared_keys(distinct, least), least, block)

    finer = stored(first.mapInArrow(_finer(least), FINER), "finer_segments")
    apart = stored(finer.groupBy("key", "digest").agg(F.min(place).alias("first"), F.max("n").alias("n"), F.max("inner").alias("inner"), F.count("*").alias("c")), "distinct_finer")
    finer_copies = later_copies(finer.drop("bytes"), ["key", "digest"], apart.where("c > 1").select("key", "digest", "first"))
    ones = apart.select("key", "digest", "first.doc_id", "first.start", "first.mark").join(shared_keys(apart, least).select("key"), "key")
    finer = finer.join(ones, ["key", "digest", "doc_id", "start", "mark"]).select("doc_id", "start", "mark", "n", "key", "bytes")
    finer_expanded, finer = in_blocks(finer, shared_keys(apart, least), least, block)

    windows = stored(finer.mapInArrow(_windows(least), WINDOWS), "windows")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    dealt = later_copies(windows, ["h1", "h2"], firsts).withColumn("n", F.lit(1))
    found = [x.select("doc_id", "start", "mark", "n") for x in (copies, finer_copies, expanded, finer_expanded, dealt)]
    return reduce(DataFrame.unionByName, found)


def shared_keys(distinct: DataFrame, least: int) -> DataFrame:
    """``(key, size)`` of the keys that can hold a repeated window, with the bytes of their different segments."""
    sizes = distinct.groupBy("key").agg(F.count("*").alias("c"), F.max("inner").alias("i"), F.sum(F.col("n").cast("long") + least - 1).alias("size"))
    return sizes.where("c > 1 or i").select("key", F.when(F.col("c") > 1, F.col("size")).otherwise(0).alias("size"))


def in_blocks(rows: DataFrame, sizes: DataFrame, least: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Repeated windows of the keys that fit into a block, and the rows of the other keys."""
    large = stored(sizes.where(F.col("size") > block).select("key"), "large_keys")
    small = rows.join(large, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    return small.mapInArrow(_blocks(least, block), REPEATS), rows.join(large, "key", "left_semi")


def _cut(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = column_bytes(batch.column(batch.schema.get_field_index("text")))
            lists = batch.column(batch.schema.get_field_index("windows"))
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            start, n = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
            last = np.cumsum(sizes)
            spans, kept = [], []
            for row in range(batch.num_rows):
                text = raw[offsets[row] : offsets[row + 1]]
                if not sizes[row]:
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                own = slice(last[row] - sizes[row], last[row])
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, start[own], 1)
                np.add.at(change, start[own] + n[own] + least - 1, -1)
                gone = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
                edges = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2).tolist()
                spans.append([{"start": a, "stop": b} for a, b in edges])
                kept.append(text[~gone[1:-1]].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [batch.column(batch.schema.get_field_index("doc_id")), pa.array(np.diff(offsets), pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "removed", "kept"])

    return run


def remove_repeated_bytes(docs: DataFrame, least: int = LEAST_BYTES, block: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_bytes, removed, kept).

    A byte of the UTF-8 text is removed if a string of ``least`` bytes that covers it starts earlier too: in a
    document of smaller id, or before in the same one; copies may overlap, and strings are judged on the input.
    ``removed`` holds the longest removed spans (start, stop) in bytes, ascending, ``kept`` the other bytes put
    together; they need not be valid UTF-8, as a copy may end inside a character.

    Null texts count as empty; texts below ``least`` bytes stay whole, and so do rows without id, which remove
    nothing either. Rows that repeat an id with its text count as one document and get the same result; those
    that repeat an id with another text rank by a hash of the text where their strings start at the same byte.
    Very long texts are cut into segments like others; a text (up to 2 GB) is held by one task at a time. An
    empty table gives an empty result; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("mark", F.hash("text"))
    found = repeated_strings(texts, least, block)
    # A set, as rows that repeat a document report the same windows again.
    found = found.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "n")).alias("windows"))
    rows = texts.join(found, ["doc_id", "mark"], "left")
    return rows.select("doc_id", "text", "windows").mapInArrow(_cut(least), RESULT)


def removal_report(found: DataFrame) -> DataFrame:
    """Digest columns of ``remove_repeated_bytes``."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
