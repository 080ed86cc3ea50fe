"""Packing of tokenised documents into windows by non-negative least squares over a length histogram.

1. Every document is tokenised once and cut into full windows and one rest.
2. The rests are counted by length in bins of ``BIN`` tokens, a histogram of at most window / BIN numbers,
   whatever the corpus. All combinations of up to ``DEPTH`` bins that fill a window are enumerated, and
   non-negative least squares finds how often each should be used to meet the histogram.
3. The repeat counts are rounded down and cut to what is there; what is left of the histogram is packed
   greedily, longest first. Both give combinations with repeat counts.
4. Pieces are numbered within their bin (counts per shard, then row numbers within the shard) and take the
   places of the combinations in turn. A sequence is put together from at most a few pieces.

Only the histogram and the plan made from it pass through the driver.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from kithwork.llm.tables import stored
from kithwork.llm.words import Hasher, Words, column_bytes, lean, slices

WINDOW = 2048
BIN = 8
DEPTH = 3
END_ID = 1
SHARD_PIECES = 50_000
CACHE_WORDS = 200_000
ENCODE_WORDS = 500
# Kinds of bytes for cutting words: ASCII letters, ASCII signs, and what keeps a word whole: digits, the
# apostrophe (contractions), "<" (special tokens) and all other bytes but the letters of two bytes 0xC3 ...
LETTER, SIGN, WHOLE = 0, 1, 2
KIND = np.array([LETTER if chr(b).isalpha() and b < 128 else SIGN if b < 128 and not chr(b).isdigit() and chr(b) not in "'<" and b > 32 and b != 127 else WHOLE for b in range(256)], np.uint8)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Token ids of texts by a tokenizer that never joins across ASCII white space, letters and signs.

    Each distinct run of letters or signs is tokenised once and kept, so the work follows the distinct runs
    of a task; words with anything else in them are kept whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core; threads of its own would hold memory
        self.tokenizer = Tokenizer.from_str(definition)
        self.hasher = Hasher()
        self._forget()

    def _forget(self):
        # Hashes in ascending order, each with the slot of its ids.
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Tokenise words new to the task. Lower-case ASCII letters pass normalisation and splitting unchanged, so
        the model alone gives their ids; the others go many in one text: no token joins across the blanks between."""
        plain = np.array([w.isascii() and w.isalpha() for w in words], bool)
        model, ids, sizes = self.tokenizer.model, [], []
        for w, p in zip(words, plain.tolist()):
            if p:
                own = [t.id for t in model.tokenize(w)]
                ids += own
                sizes.append(len(own))
        pool, count = [self.pool, np.array(ids, np.uint32)], [self.count, np.array(sizes, np.int64)]
        others = [w for w, p in zip(words, plain.tolist()) if not p]
        texts = [others[k : k + ENCODE_WORDS] for k in range(0, len(others), ENCODE_WORDS)]
        for own, encoded in zip(texts, self.tokenizer.encode_batch([" ".join(t) for t in texts], add_special_tokens=False)):
            starts = np.cumsum([0] + [len(w) + 1 for w in own])[:-1]
            places = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(encoded))
            count.append(np.bincount(np.searchsorted(starts, places, side="right") - 1, minlength=len(own)))
            pool.append(np.array(encoded.ids, np.uint32))
        hashes = np.concatenate((hashes[plain], hashes[~plain]))
        by = np.argsort(hashes)
        slots = np.arange(len(self.count), len(self.count) + len(words))
        self.pool, self.count = np.concatenate(pool), np.concatenate(count)
        self.first = np.cumsum(self.count) - self.count
        at = np.searchsorted(self.known, hashes[by])
        self.known, self.slot = np.insert(self.known, at, hashes[by]), np.insert(self.slot, at, slots[by])

    def _runs(self, words: Words) -> Words:
        """Words cut into runs of letters and runs of signs where they hold nothing else."""
        data = words.data
        kind = KIND[data]
        two = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
        two = two[(data[two + 1] != 0x97) & (data[two + 1] != 0xB7)]
        kind[two] = kind[two + 1] = LETTER
        whole = np.concatenate(([0], np.cumsum(kind == WHOLE)))
        simple = whole[words.end] == whole[words.start]
        # Word of every byte (0: none), to cut only inside simple words.
        inside = np.zeros(len(data) + 1, np.int32)
        inside[words.start[simple]] += 1
        inside[words.end[simple]] -= 1
        inside = np.cumsum(inside[:-1]) > 0
        cut = np.flatnonzero(inside[1:] & inside[:-1] & (kind[1:] != kind[:-1])) + 1
        cut = cut[~np.isin(cut, words.start)]
        start, end = np.sort(np.concatenate((words.start, cut))), np.sort(np.concatenate((words.end, cut)))
        bounds = np.append(words.start, len(data) + 1)[words.first]
        return Words(self.hasher.spans(data, start, end), np.searchsorted(start, bounds), start, end, data)

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts between ``offsets``, each text closed by END_ID, and where each text starts."""
        if len(self.known) > CACHE_WORDS:
            self._forget()
        words = self._runs(self.hasher.words(raw, offsets))
        own, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, own)
        known = at < len(self.known)
        known[known] = self.known[at[known]] == own[known]
        new = np.flatnonzero(~known)
        if len(new):
            data = words.data
            self._learn(own[new], [data[words.start[i] : words.end[i]].tobytes().decode("utf-8", "replace") for i in first[new].tolist()])
        slot = self.slot[np.searchsorted(self.known, own)][inverse]
        counts = self.count[slot]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.first[slot] - (ends - counts), counts) + np.arange(total)]
        starts = np.concatenate(([0], ends))[words.first]
        ids = np.insert(ids, starts[1:], np.uint32(END_ID))
        return ids, starts + np.arange(len(starts))


# Words of all kinds: letters, signs, digits, contractions, letters outside ASCII, several blanks.
PROBE = "The quick, brown-fox's (jumps) 12 times; don't!  ÉTÉ straße naïve\n日本語 a_b x=y... ü~ö\tend"


def check_tokenizer(definition: str) -> None:
    """Refuse a tokenizer whose ids of a text are not those of its words."""
    raw, offsets = column_bytes(pa.array([PROBE]))
    found = WordTokenizer(definition).ids(raw, offsets)[0].tolist()
    if found != [*Tokenizer.from_str(definition).encode(PROBE, add_special_tokens=False).ids, END_ID]:
        raise ValueError("packing needs a tokenizer that drops white space and splits words at signs")


def _pieces(definition, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(definition.value)
        for batch in batches:
            doc = batch.column(0).to_pylist()
            raw, offsets = column_bytes(batch.column(1))
            rows = []
            for lo, hi in slices(offsets):
                ids, starts = tokenizer.ids(raw, offsets[lo : hi + 1])
                for d, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                    for at in range(a, b, window):
                        piece = ids[at : min(at + window, b)]
                        rows.append((doc[lo + d], at - a, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), b - a))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Descending bins that fill ``bins`` exactly, up to ``depth`` of them."""
    out = [(bins,)]

    def extend(head: tuple[int, ...], left: int):
        if len(head) and left <= head[-1]:
            out.append((*head, left))
        if len(head) + 1 < depth:
            for b in range(min(left - 1, head[-1] if head else left - 1), 0, -1):
                extend((*head, b), left - b)

    extend((), bins)
    return sorted(set(out), reverse=True)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 2000, ridge: float = 1e-9) -> np.ndarray:
    """Active-set solution of min |a x - b| with x >= 0; the ridge only keeps the small systems solvable."""
    x = np.zeros(a.shape[1])
    passive = np.zeros(a.shape[1], bool)
    for _ in range(steps):
        slope = a.T @ (b - a @ x)
        slope[passive] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            own = a[:, at]
            trial = np.linalg.solve(own.T @ own + ridge * np.eye(len(at)), own.T @ b)
            if (trial > 1e-12).all():
                x[:] = 0
                x[at] = trial
                break
            negative = trial <= 1e-12
            ratio = x[at][negative] / np.maximum(x[at][negative] - trial[negative], 1e-300)
            move = float(ratio.min())
            x[at] += move * (trial - x[at])
            passive[at[x[at] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


def packing_plan(histogram: dict[int, int], bins: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of bins and how often each is used; together they hold the histogram exactly."""
    left = np.zeros(bins + 1, np.int64)
    for b, n in histogram.items():
        left[b] += n
    plan = []

    def take(combination: tuple[int, ...], most: int):
        need = Counter(combination)
        n = min([most, *(int(left[b]) // k for b, k in need.items())])
        if n > 0:
            plan.append((combination, n))
            for b, k in need.items():
                left[b] -= k * n

    shapes = combinations(bins, depth)
    matrix = np.zeros((bins, len(shapes)))
    for s, shape in enumerate(shapes):
        for b in shape:
            matrix[b - 1, s] += 1
    scale = max(1, left.max())
    repeats = nonnegative_least_squares(matrix, left[1:] / scale) * scale
    for s in np.argsort(-repeats, kind="stable"):
        if repeats[s] >= 1:
            take(shapes[s], int(repeats[s] + 1e-6))
    while left.any():
        shape, room = [], bins
        spare = left.copy()
        while room > 0 and spare[1 : room + 1].any():
            b = int(np.flatnonzero(spare[1 : room + 1])[-1]) + 1
            shape.append(b)
            spare[b] -= 1
            room -= b
        take(tuple(shape), int(left.sum()))
    return plan


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, width: int = BIN, depth: int = DEPTH) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is the ids of its whole text, without special tokens, and one END_ID; a null or empty text is
    the END_ID alone. Every id lies in exactly one piece; full windows are sequences of their own, rests
    share one. ``path`` names the tokenizer file, read on the driver and sent to the tasks; one that joins across
    white space, or across letters and signs, is refused. Rows with a null doc_id and repeated rows are packed
    like any other. Ties between pieces of a bin go by id and start within a shard of pieces. An empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    check_tokenizer(definition.value)
    bins = window // width
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(lean(_pieces(definition, window)), PIECES).withColumn("bin", F.ceil(F.col("length") / width).cast("int"))
    # Pieces are dealt out by a number of their own, so that no id, or row without one, is a hot shard.
    pieces = stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    histogram = {r["bin"]: r["count"] for r in pieces.groupBy("bin").count().collect()}
    shards = 1 + sum(histogram.values()) // SHARD_PIECES
    places, base = [], 0
    filled: Counter = Counter()
    for shape, n in packing_plan(histogram, bins, depth):
        for position, b in enumerate(shape):
            places.append((b, filled[b], filled[b] + n, base, position))
            filled[b] += n
        base += n
    places = spark.createDataFrame(places, "bin int, lo long, hi long, base long, position int")
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("piece"), F.lit(shards)).cast("int"))
    before = Window.partitionBy("bin").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ahead = pieces.groupBy("bin", "shard").count().select("bin", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("bin", "shard").orderBy("doc_id", "start", "length", "ids_crc32", "piece")
    numbered = pieces.withColumn("row", F.row_number().over(own) - 1).join(ahead, ["bin", "shard"]).withColumn("number", F.col("ahead") + F.col("row"))
    inside = (numbered["bin"] == places["bin"]) & (numbered["number"] >= places["lo"]) & (numbered["number"] < places["hi"])
    placed = numbered.join(F.broadcast(places), inside)
    placed = placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("number") - F.col("lo")).alias("sequence_id"), "position")
    earlier = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset)
