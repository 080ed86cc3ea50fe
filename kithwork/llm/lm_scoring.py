"""Language-model scores from a log-frequency Bloom filter with quantised n-gram counts.

1. Tokens and pairs of neighbouring tokens of the training texts are counted, with partial sums in every
   task. Grams travel as 64-bit hashes.
2. The filter holds every gram with a count of at least ``LEAST``: one with quantised count level q is
   entered as (gram, 1) to (gram, q), q = 1 + floor(log(count / LEAST) / log(STEP)). Its size follows the
   number of entries at ``BITS_PER_ENTRY`` (an error rate of about 1 %) up to ``FILTER_BYTES``; beyond that
   all grams are still entered and the error rate rises. It is built in parts, each in a task of its own,
   and broadcast.
3. A count is read back by probing levels 1, 2, ... until one is missing; the middle of the level's range
   is the estimate. P(w | h) = (est(h, w) + MU * p(w)) / (est(h) + MU), where p(w) is the exact add-one
   probability of the token, so unseen pairs fall back to it.
4. Exact token counts: the at most ``HEAD`` most frequent tokens are broadcast. Every occurrence of another
   token becomes a row and meets its count in a join. Such tokens are rare in the training texts; one that
   only other texts repeat (held-out ones, rows without id) can be frequent there, and adaptive execution
   splits its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.tables import fold, stored
from kithwork.llm.words import Hasher, column_bytes, mix, slices

LEAST = 2
STEP = 1.5
BITS_PER_ENTRY = 10
PROBES = 7
FILTER_BYTES = 256 << 20
PART_BYTES = 1 << 20
HEAD = 1 << 20
MU = 1000.0
FLUSH_TOKENS = 2_000_000

TOKEN, PAIR = 1, 2
END = np.uint64(0x60642E2A34326F15)
START = np.uint64(0x2B7E151628AED2A6)
SCORED = "row long, doc_id long, n_tokens long, n_known long, base double, model double, token long, pair double, rest double"


def token_stream(hasher: Hasher, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, pair with the token before, first token of each text) of the texts, END after each."""
    words = hasher.words(raw, offsets)
    tokens = np.insert(words.hashes, words.first[1:], END)
    first = words.first + np.arange(len(words.first))
    before = np.concatenate(([START], tokens[:-1])) if len(tokens) else tokens
    before[first[:-1]] = START
    return tokens, mix(before * np.uint64(0x9FB21C651E98DF25) + tokens), first


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        for kind in (TOKEN, PAIR):
            if held:
                gram, n = np.unique(np.concatenate([h[kind - 1] for h in held]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(gram), kind, np.int8)), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], names=["kind", "gram", "n"]
                )
        held.clear()

    for batch in batches:
        raw, offsets = column_bytes(batch.column(0))
        for lo, hi in slices(offsets):
            tokens, pairs, first = token_stream(hasher, raw, offsets[lo : hi + 1])
            # The start of a text is a history like a token; it is counted once per text.
            held.append((np.concatenate((tokens, np.full(hi - lo, START, np.uint64))), pairs))
            if sum(len(h[1]) for h in held) >= FLUSH_TOKENS:
                yield from flush()
    yield from flush()


def gram_counts(texts: DataFrame) -> DataFrame:
    """(kind, gram, n) of a frame with one text column: tokens, the start mark, and pairs seen LEAST times."""
    partial = texts.mapInArrow(_counts, "kind byte, gram long, n long")
    return partial.groupBy("kind", "gram").agg(F.sum("n").alias("n")).where((F.col("kind") == TOKEN) | (F.col("n") >= LEAST))


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts / LEAST) / math.log(STEP) + 1e-9).astype(np.int64)


def level_middle(level: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level; level 0 is no count."""
    low, high = np.ceil(LEAST * STEP ** (level - 1.0) - 1e-9), np.ceil(LEAST * STEP ** level.astype(float) - 1e-9) - 1
    return np.where(level > 0, (low + np.maximum(high, low)) / 2, 0.0)


def entry_hashes(grams: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (gram, level); probe k looks at bit ``first + k * second``, cut to the size of a part."""
    first = mix(grams + np.uint64(0xD6E8FEB86659FD93 * level & 0xFFFFFFFFFFFFFFFF))
    return first, (first >> np.uint64(32)) | np.uint64(1)


def filter_part(grams: np.ndarray, counts: np.ndarray, size: int, probes: int) -> bytes:
    """The bits of a part of ``size`` bytes, a power of two."""
    part = np.zeros(size * 8, bool)
    mask = np.uint64(size * 8 - 1)
    top = levels(counts)
    for level in range(1, int(top.max()) + 1):
        first, second = entry_hashes(grams[top >= level], level)
        for probe in range(probes):
            part[((first + np.uint64(probe) * second) & mask).astype(np.int64)] = True
    return np.packbits(part, bitorder="little").tobytes()


def _parts(size: int, probes: int):
    def run(group: pa.Table) -> pa.Table:
        content = filter_part(group["gram"].to_numpy().view(np.uint64), group["n"].to_numpy(), size, probes)
        return pa.table({"part": group["part"][:1], "content": pa.array([content], pa.binary())})

    return run


class LogFrequencyFilter:
    """Parts of equal size, a power of two; a gram belongs to part ``gram mod parts``."""

    def __init__(self, parts: np.ndarray, probes: int):
        self.bytes, self.probes = np.ascontiguousarray(parts).ravel(), probes  # uint8, one row per part
        self.parts, self.size = parts.shape
        self.middle = level_middle(np.arange(200))

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Estimated counts, by repeated membership probes."""
        level = np.zeros(len(grams), np.int64)
        at = np.arange(len(grams))
        part = (grams % np.uint64(self.parts)).astype(np.int64) * self.size if self.parts > 1 else np.zeros(len(grams), np.int64)
        mask = np.uint64(self.size * 8 - 1)
        step = 1
        while len(at) and step < len(self.middle):
            first, second = entry_hashes(grams[at], step)
            for probe in range(self.probes):
                bit = (first + np.uint64(probe) * second) & mask
                byte = self.bytes[part + (bit >> np.uint64(3)).astype(np.int64)]
                there = (byte >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at, part, first, second = at[there], part[there], first[there], second[there]
            level[at] = step
            step += 1
        return self.middle[level]


def build_filter(counts: DataFrame) -> tuple[np.ndarray, int]:
    """The parts of the filter over (gram, n), n >= LEAST, at most FILTER_BYTES in all, and its probes per entry."""
    entries = counts.agg(F.sum(F.floor(F.log(F.col("n") / LEAST) / math.log(STEP) + 1e-9) + 1)).first()[0] or 0
    need = min(FILTER_BYTES, max(64, entries * BITS_PER_ENTRY // 8 + 1))
    size = min(PART_BYTES, 1 << (need - 1).bit_length())
    parts = -(-need // size)
    probes = max(1, min(PROBES, round(math.log(2) * 8 * size * parts / max(entries, 1))))
    # pmod of the unsigned value, as the probes compute it
    signed = F.pmod(F.col("gram"), F.lit(parts))
    part = F.when(F.col("gram") >= 0, signed).otherwise(F.pmod(signed + (1 << 64) % parts, F.lit(parts))).cast("int")
    made = counts.select(part.alias("part"), "gram", "n").groupBy("part").applyInArrow(_parts(size, probes), "part int, content binary")
    out = np.zeros((parts, size), np.uint8)
    for row in made.toLocalIterator():
        out[row["part"]] = np.frombuffer(row["content"], np.uint8)
    return out, probes


def head_counts(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """The most frequent tokens, at most HEAD, sorted by hash, their counts, and the smallest count among them.

    The bound on the count is a power of two, found from the number of tokens per power.
    """
    power = F.floor(F.log2("n") + 1e-9).cast("int")
    sizes = sorted(((r["p"], r["count"]) for r in tokens.groupBy(power.alias("p")).count().collect()), reverse=True)
    least, total = None, 0
    for p, n in sizes:
        if total + n > HEAD:
            break
        total, least = total + n, 1 << p
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 1 << 62
    rows = tokens.where(F.col("n") >= least).select("gram", "n").toArrow()
    gram, n = rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(gram)
    return gram[order], n[order], least


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        held = LogFrequencyFilter(*own["filter"])
        head, head_n, total = own["head"], own["head_n"], own["total"]
        hasher = Hasher()
        row = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in SCORED.split(", ")]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False) if not batch.column(0).null_count else np.array(batch.column(0).to_pylist(), object)
            raw, offsets = column_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                tokens, pairs, first = token_stream(hasher, raw, offsets[lo : hi + 1])
                text = np.repeat(np.arange(hi - lo), np.diff(first))
                kinds, inverse = np.unique(tokens, return_inverse=True)
                at = np.minimum(np.searchsorted(head, kinds), max(len(head) - 1, 0))
                frequent = (head[at] == kinds) if len(head) else np.zeros(len(kinds), bool)
                count = np.where(frequent, head_n[at] if len(head) else 0, 0)
                seen = held.counts(kinds)
                start = held.counts(np.array([START]))[0]
                history = np.concatenate(([start], seen[inverse][:-1]))
                history[first[:-1]] = start
                # A pair in the filter has both its tokens there; the others need no probe.
                both = np.zeros(len(tokens))
                likely = np.flatnonzero((history > 0) & (seen[inverse] > 0))
                both[likely] = np.minimum(held.counts(pairs[likely]), history[likely])
                pair, rest = both / (history + MU), MU / (history + MU)
                known = frequent[inverse]
                p = (count[inverse] + 1) / total
                n = hi - lo
                sums = [np.bincount(text[known], values[known], minlength=n) for values in (np.log10(p), np.log10(pair + rest * p))]
                numbers = row + np.arange(n)
                none = pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), pa.array(ids[lo:hi], pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(np.bincount(text[known], minlength=n), pa.int64()),
                     pa.array(sums[0], pa.float64()), pa.array(sums[1], pa.float64()), none(n, pa.int64()), none(n, pa.float64()), none(n, pa.float64())], names=names,
                )
                rare = ~known
                m = int(rare.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[text[rare]]), none(m, pa.int64()), none(m, pa.int64()), none(m, pa.int64()), none(m, pa.float64()), none(m, pa.float64()),
                     pa.array(tokens[rare].view(np.int64)), pa.array(pair[rare], pa.float64()), pa.array(rest[rare], pa.float64())], names=names,
                )
                row += n

    return run


def lm_scores(docs: DataFrame, modulus: int = 7, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Tokens are the words of the text with A-Z lower-cased and one end mark; a null text is empty and has the
    end mark only. Rows with ``crc32(doc_id) % modulus != held_out`` are learned from; rows with a null
    doc_id are not, they are scored and their fold is null. Repeated rows are learned from and scored each.
    ``base_score`` is the add-one unigram log10 probability from exact counts, ``score`` that of the model.
    Without training rows all tokens are unknown and share probability 1. An empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = stored(gram_counts(rows.where(fold("doc_id", modulus) != held_out).select("text")), "grams")
    mark = int(START.view(np.int64))
    tokens = counts.where((F.col("kind") == TOKEN) & (F.col("gram") != mark))
    size, kinds = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head, head_n, least = head_counts(tokens)
    total = size + kinds + 1
    model = spark.sparkContext.broadcast({"filter": build_filter(counts.where(F.col("n") >= LEAST)), "head": head, "head_n": head_n, "total": total})
    scored = stored(rows.mapInArrow(_scores(model), SCORED), "scored")
    rare = scored.where("token is not null").select("row", "token", "pair", "rest")
    known = tokens.where(F.col("n") < least).select(F.col("gram").alias("token"), "n")
    p = (F.coalesce("n", F.lit(0)) + 1) / F.lit(float(total))
    rare = rare.join(known, "token", "left").groupBy("row").agg(
        F.count("n").alias("rare_known"), F.sum(F.log10(p)).alias("rare_base"), F.sum(F.log10(F.col("pair") + F.col("rest") * p)).alias("rare_model")
    )
    whole = scored.where("token is null").join(rare, "row", "left")
    added = {c: F.coalesce(c, F.lit(0)) for c in ("rare_known", "rare_base", "rare_model")}
    return whole.select(
        "doc_id", (fold("doc_id", modulus) == held_out).alias("held_out"), "n_tokens", (F.col("n_known") + added["rare_known"]).alias("n_known"),
        F.lit(size).cast("long").alias("train_tokens"), (F.col("base") + added["rare_base"]).alias("base_score"), (F.col("model") + added["rare_model"]).alias("score"),
    )
