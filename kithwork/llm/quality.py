"""Quality score from compression: text that a dictionary of good text shortens more is better.

Two zstandard dictionaries are trained, on good and on bad labelled text. A text is cut into pieces of
``PIECE`` bytes (all of them count; within a piece the dictionary matters more than the text's own history)
and compressed with both. The normalised difference of the sizes and the ratios themselves go through a
logistic calibration that is fitted on labelled rows the dictionaries have not seen. Lines that several
training texts share are left out of the dictionaries.

The fit uses at most ``SAMPLE`` rows of each class, those with the smallest id hash, of texts up to
``SAMPLE_BYTES``: every third trains the dictionaries, the others the calibration, weighted by the true
class counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.logistic import fit_logistic, sigmoid
from kithwork.llm.tables import fold, labelled_sample
from kithwork.llm.words import column_bytes, lean

SAMPLE = 3000
SAMPLE_BYTES = 50_000
PIECE = 1024
DICTIONARY_BYTES = 65_536
LEVEL = 3
THRESHOLD = 0.7


def pieces(text: bytes) -> list[bytes]:
    return [text[at : at + PIECE] for at in range(0, len(text), PIECE)] or [b""]


def without_shared_lines(by_class: dict[int, list[bytes]]) -> dict[int, list[bytes]]:
    """The texts without lines that several of them have: those say where a text is from, not how good it is."""
    held = Counter(line for texts in by_class.values() for text in texts for line in set(text.split(b"\n")))
    out = {c: [b"\n".join(line for line in text.split(b"\n") if held[line] == 1) for text in texts] for c, texts in by_class.items()}
    return {c: texts if any(texts) else by_class[c] for c, texts in out.items()}


def train_dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the end of the texts themselves where they are too few to train one."""
    samples = [piece for text in texts for piece in pieces(text) if piece]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Compressors:
    """Measures compressed sizes with the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.both = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        if len(content) < 8:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, text: bytes) -> tuple[int, int, int]:
        good, bad = (c.compress for c in self.both)
        cut = pieces(text)
        return len(text), sum(len(good(p)) for p in cut), sum(len(bad(p)) for p in cut)


def features(sizes: list[tuple[int, int, int]]) -> np.ndarray:
    raw, good, bad = np.array(sizes, np.float64).reshape(-1, 3).T
    raw = raw + 20
    difference = (bad - good) / np.maximum(np.maximum(good, bad), 1)
    ratio, other, length = good / raw, bad / raw, np.log(raw)
    return np.c_[difference, difference * length, (bad - good) / raw, ratio, ratio**2, other, other**2, np.log(ratio + 1e-3), length]


def fit_quality(by_class: dict[int, list[bytes]], counts: dict[int, int]) -> dict:
    """The model from sampled texts per class: two dictionaries and the calibration, bounded in size."""
    known = sum(counts.values())
    if not by_class[0] or not by_class[1]:
        return {"good": b"", "bad": b"", "weights": None, "constant": float(counts.get(1, 0) / known if known else 0.5)}
    own = without_shared_lines(by_class)
    good, bad = (train_dictionary(own[c][::3]) for c in (1, 0))
    compressors = Compressors(good, bad)
    sizes, y, weight = [], [], []
    for c, texts in by_class.items():
        rest = [t for i, t in enumerate(texts) if i % 3] or texts
        sizes += [compressors.sizes(t) for t in rest]
        y += [c] * len(rest)
        weight += [counts[c] / len(rest)] * len(rest)
    weight = np.array(weight) * len(weight) / np.sum(weight)
    return {"good": good, "bad": bad, "weights": fit_logistic(features(sizes), np.array(y), weight), "constant": None}


def text_scores(model: dict, compressors: Compressors, texts: pa.Array) -> np.ndarray:
    raw, offsets = column_bytes(texts)
    if model["weights"] is None:
        return np.full(len(offsets) - 1, model["constant"])
    at = offsets.tolist()
    x = features([compressors.sizes(raw[a:b].tobytes()) for a, b in zip(at, at[1:])])
    return sigmoid(x @ model["weights"][:-1] + model["weights"][-1])


def _scores(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(model["good"], model["bad"])
        for batch in batches:
            score = text_scores(model, compressors, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) for every row of ``docs``; a null text counts as empty. Only the text decides."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id long, score double")


def _good(model: dict, text: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(model["good"], model["bad"])
        for batch in batches:
            yield batch.filter(pa.array(text_scores(model, compressors, batch.column(text)) >= threshold))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``; no shuffle of the texts."""
    model = fit_quality(*labelled_sample(docs, labels, "quality", modulus, held_out, SAMPLE, SAMPLE_BYTES))
    return docs.mapInArrow(lean(_good(model, docs.columns.index("text"), threshold)), docs.schema)


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; score nearer 1: quality 1 likelier.

    Labels are learned from rows with ``crc32(doc_id) % modulus != held_out`` only. Null and empty texts
    are scored as empty texts; a null doc_id is scored and has a null fold; repeated rows are scored each.
    Without labels of both classes the score is the share of good labels, or 0.5 without any. An empty
    table gives an empty result. Columns other than doc_id and text are not read.
    """
    model = fit_quality(*labelled_sample(docs, labels, "quality", modulus, held_out, SAMPLE, SAMPLE_BYTES))
    scored = score_quality(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
