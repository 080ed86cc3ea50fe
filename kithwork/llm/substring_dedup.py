"""Substring dedup: lines and the sentences in them are hashed, and of equal ones only the first stays.

A unit ends after a line end and after a blank that follows ``.``, ``!`` or ``?``, so the units of a text
put together are the text. Its digest (128 bits) covers its words with A-Z lower-cased; white space does
not count. Units of fewer than ``MIN_WORDS`` words always stay. Of the units with one digest, in all
documents together, the one with the smallest (doc_id, offset) stays; the spans of the others are removed
and reported with their offsets in the original text.

The digests are counted with partial sums in every task; the join that finds the later occurrences is an
inner equi-join, which adaptive execution splits where one digest is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.words import BASE, INVERSE, Hasher, column_bytes, lean, mix, powers, slices

MIN_WORDS = 5
UNITS = "doc_id long, start int, stop int, h1 long, h2 long"
SPAN = "array<struct<start: int, stop: int>>"


def unit_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions after which a unit ends; every text border is one."""
    before = np.concatenate(([0], data[:-1])).astype(np.uint8)
    stop = (data == 10) | ((data == 32) & np.isin(before, (33, 46, 63)))
    # The sign before a blank must be of the same text.
    first = bounds[:-1][bounds[:-1] < len(data)]
    stop[first] &= data[first] == 10
    ends = np.flatnonzero(stop) + 1
    return np.unique(np.concatenate((ends, bounds[1:])))


class UnitHasher:
    def __init__(self):
        self.hasher = Hasher()
        self.up = self.down = np.zeros(0, np.uint64)

    def units(self, raw: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
        """(text, start, stop, h1, h2) of the units with at least ``least`` words; offsets in code points."""
        words = self.hasher.words(raw, offsets)
        bounds = offsets - offsets[0]
        stop = unit_ends(words.data, bounds)
        stop = stop[stop > 0]
        start = np.concatenate((np.zeros(1, stop.dtype), stop[:-1]))[: len(stop)]
        a, b = np.searchsorted(words.start, start), np.searchsorted(words.start, stop)
        long = b - a >= max(least, 1)
        start, stop, a, b = start[long], stop[long], a[long], b[long]
        n = len(words.hashes)
        if n > len(self.up):
            self.up, self.down = powers(2 * n, BASE), powers(2 * n, INVERSE)
        digests = []
        for salt in (0, 0x2545F4914F6CDD1D):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(mix(words.hashes ^ np.uint64(salt)) * self.up[:n], out=total[1:])
            digests.append(mix((total[b] - total[a]) * self.down[a] + (b - a).astype(np.uint64)).view(np.int64))
        chars = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
        text = np.searchsorted(bounds, start, side="right") - 1
        base = chars[bounds[text]]
        return text, chars[start] - base, chars[stop] - base, *digests


def _units(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = UnitHasher()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                text, start, stop, h1, h2 = hasher.units(raw, offsets[lo : hi + 1], least)
                columns = [pa.array(ids[lo + text], pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(h1), pa.array(h2)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "stop", "h1", "h2"])

    return run


def repeated_units(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start, stop, first_doc, first_start): every later occurrence of a unit, and the one that stays."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    units = rows.where("doc_id is not null and text <> ''").mapInArrow(lean(_units(least)), UNITS)
    firsts = units.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select("h1", "h2", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start"))
    later = units.join(firsts, ["h1", "h2"]).where("doc_id <> first_doc or start <> first_start")
    return later.select("doc_id", "start", "stop", "first_doc", "first_start")


def without_spans(text: str, spans: list[dict]) -> str:
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : span["start"]])
        at = span["stop"]
    return "".join([*kept, text[at:]])


def _cut(text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1).to_pylist()
            texts = batch.column(text).to_pylist()
            texts = [t if t is None or not own else without_spans(t, own) for t, own in zip(texts, spans)]
            yield batch.set_column(text, batch.schema.names[text], pa.array(texts, pa.string()))

    return run


def remove_repeated(docs: DataFrame, least: int = MIN_WORDS, removed: str = "removed") -> DataFrame:
    """The rows of ``docs`` with all columns, ``text`` without later occurrences of units, and ``removed``.

    ``removed`` must not be a column of ``docs``.
    """
    # A set, as rows that repeat a doc_id report the same spans again.
    found = repeated_units(docs, least).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias(removed))
    found = found.withColumnRenamed("doc_id", "_kithwork_owner")
    rows = docs.withColumn("text", F.col("text").cast("string"))
    rows = rows.join(found, F.col("doc_id").cast("long") == F.col("_kithwork_owner"), "left").drop("_kithwork_owner")
    schema = rows.withColumn(removed, F.col(removed).cast(SPAN)).schema
    return rows.select(*docs.columns, F.col(removed).cast(SPAN).alias(removed)).mapInArrow(lean(_cut(docs.columns.index("text"))), schema)


def substring_dedup(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text, removed, n_removed).

    ``text`` is what stays, ``removed`` the removed spans (start, stop) in code points of the original text,
    ascending. Null texts stay null, empty ones empty. Units of fewer than ``least`` words always stay, also in a
    copied passage, and so does the part of a passage that shares a sentence with other text. Rows without id are left as they are. Ties cannot
    occur: (doc_id, offset) ranks units; rows that repeat a doc_id with its text count as one document. An
    empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = remove_repeated(rows, least)
    removed = F.coalesce("removed", F.array().cast(SPAN))
    return cut.select("doc_id", "text", removed.alias("removed"), F.size(removed).alias("n_removed"))
