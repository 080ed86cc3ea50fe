"""Toxicity score: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text has a feature for every distinct n-gram of 3 to 5 characters of its lower-cased text, hashed to
``2**BITS`` buckets. The log-count ratio of a bucket compares how much of the toxic and of the other
training texts it makes up; features are 0 or that ratio, and a logistic regression is fitted on them. The
``KEEP`` buckets whose ratios are the most reliable take part; the model is bounded by that number.

The fit uses at most ``SAMPLE`` labelled rows of each class, those with the smallest id hash, of texts up
to ``SAMPLE_BYTES``, weighted by the true class counts. Scoring reads every character of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.logistic import sigmoid
from kithwork.llm.tables import fold, labelled_sample
from kithwork.llm.words import column_bytes, slices

SIZES = (3, 4, 5)
BITS = 18
KEEP = 1 << 14
SAMPLE = 4000
SAMPLE_BYTES = 20_000
SMOOTHING = 1.0
RIDGE = 1e-3
STEPS = 300


def code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the texts between ``offsets`` with a blank before each text, and the text of each."""
    data = raw[offsets[0] : offsets[-1]]
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets - offsets[0]]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(heads) + 1)
    return np.insert(chars, heads[:-1], np.uint32(32)), text


def gram_buckets(chars: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram within one text, for each size in turn."""
    code = (chars + np.uint32(1)) * np.uint32(0x9E3779B1)
    rolled = code
    for size in range(2, max(SIZES) + 1):
        if len(code) < size:
            return
        rolled = rolled[:-1] * np.uint32(0x01000193) + code[size - 1 :]
        if size in SIZES:
            inside = text[: len(rolled)] == text[size - 1 :]
            value = rolled ^ (rolled >> np.uint32(15))
            yield text[: len(rolled)][inside], ((value * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))[inside]


def distinct_features(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct buckets of each text."""
    out = []
    for content in texts:
        raw = np.frombuffer(content.decode("utf-8", "replace").lower().encode(), np.uint8)
        found = [b for _, b in gram_buckets(*code_points(raw, np.array([0, len(raw)])))]
        out.append(np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32))
    return out


def log_count_ratios(toxic: np.ndarray, other: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    p, q = toxic + smoothing, other + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit_toxicity(by_class: dict[int, list[bytes]], counts: dict[int, int]) -> dict:
    """The model from sampled texts per class: a place for each kept bucket, weights and intercept."""
    known = sum(counts.values())
    if not by_class[1] or not by_class[0]:
        return {"place": None, "weights": None, "intercept": None, "constant": float(counts.get(1, 0) / known if known else 0.5)}
    features = {c: distinct_features(texts) for c, texts in by_class.items()}
    held = {c: np.bincount(np.concatenate(f), minlength=1 << BITS).astype(float) for c, f in features.items()}
    ratio = log_count_ratios(held[1], held[0])
    trust = np.abs(ratio) * np.sqrt(held[1] + held[0])
    kept = np.sort(np.argsort(-trust, kind="stable")[:KEEP])
    kept = kept[(held[1] + held[0])[kept] > 0]
    place = np.full(1 << BITS, -1, np.int32)
    place[kept] = np.arange(len(kept))
    rows = [place[f] for c in (1, 0) for f in features[c]]
    rows = [r[r >= 0] for r in rows]
    y = np.repeat([1.0, 0.0], [len(features[1]), len(features[0])])
    weight = np.repeat([counts[c] / len(features[c]) for c in (1, 0)], [len(features[c]) for c in (1, 0)])
    weight /= weight.sum()
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = ratio[kept]
    w, b = np.zeros(len(kept)), np.log(counts[1] / counts[0])
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, (w * scale)[flat], minlength=len(rows)) + b
        error = weight * (sigmoid(z) - y)
        slope = np.append(np.bincount(flat, error[owner], minlength=len(kept)) * scale + RIDGE * w, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return {"place": place, "weights": w * scale, "intercept": float(b), "constant": None}


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            score = np.full(len(batch), own["constant"] if own["place"] is None else own["intercept"], float)
            if own["place"] is not None:
                keep = len(own["weights"])
                for lo, hi in slices(offsets):
                    found = []
                    for text, bucket in gram_buckets(*code_points(raw, offsets[lo : hi + 1])):
                        at = own["place"][bucket]
                        used = at >= 0
                        found.append(text[used] * keep + at[used])
                    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
                    score[lo:hi] += np.bincount(pairs // keep, own["weights"][pairs % keep], minlength=hi - lo)
                score = sigmoid(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) for every row of ``docs``; a null text counts as empty. Only the text decides."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    return rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; score nearer 1: toxic likelier.

    Labels are learned from rows with ``crc32(doc_id) % modulus != held_out`` only. Null and empty texts
    are scored as empty texts; a null doc_id is scored and has a null fold; repeated rows are scored each.
    Without labels of both classes the score is the share of toxic labels, or 0.5 without any. An empty
    table gives an empty result. Columns other than doc_id and text are not read.
    """
    model = fit_toxicity(*labelled_sample(docs, labels, "toxic", modulus, held_out, SAMPLE, SAMPLE_BYTES))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
