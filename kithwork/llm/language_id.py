"""Language of a text from a linear-chain conditional random field over its words.

A word's features are the character n-grams of 2 to 4 of the word between start and end marks (those with
a mark are its affixes) and, if it is in the lexicon of frequent training words, the word itself; all are
hashed to ``2**BITS`` rows of weights, one per language. Transitions between the languages of neighbouring
words are learned too. Forward-backward gives every word its distribution over languages, so text that
switches between languages is labelled word by word; the language of a text is the one with the largest
mean probability over all its words.

Long texts are cut into segments of ``SEGMENT`` words whose transfer matrices are multiplied side by side
and then chained, so the cost per word does not depend on the length and no text is cut short.

The fit uses at most ``SAMPLE`` texts per language, those with the smallest id hash, of at most
``SAMPLE_BYTES``. Their words are dealt out in runs of ``RUN`` words to mixed sequences, so switches occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.tables import excerpt, fold, hash_sample
from kithwork.llm.words import Hasher, column_bytes, slices

GRAMS = (2, 3, 4)
BITS = 16
LEXICON_COUNT = 3
SAMPLE = 60
SAMPLE_BYTES = 20_000
RUN = 40
SEQUENCE_RUNS = 20
STEPS = 40
RATE = 0.1
RIDGE = 1e-7
SEGMENT = 128
GROUP_WORDS = 500_000
NONE = "und"
FIRST_MARK, LAST_MARK = np.uint32(0x110000), np.uint32(0x110001)


def letters(chars: np.ndarray) -> np.ndarray:
    """True for letters below U+0250; characters above it count as letters."""
    known = np.array([chr(c).isalpha() for c in range(0x250)])
    return np.where(chars < 0x250, known[np.minimum(chars, 0x24F)], True)


def word_features(words: list[bytes], hashes: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word position, weight row) of all features of distinct lower-cased words."""
    text = b" ".join(words).decode("utf-8", "replace")
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    owner = np.cumsum(chars == 32)
    keep = letters(chars) & (chars != 32)
    chars, owner = chars[keep], owner[keep]
    if not len(chars):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    ends = np.append(starts[1:], len(chars))
    places = np.concatenate((starts, ends))
    marks = np.concatenate((np.full(len(starts), FIRST_MARK), np.full(len(ends), LAST_MARK)))
    whose = np.concatenate((owner[starts], owner[ends - 1]))
    # At a common place the mark that ends a word comes before the one that starts the next.
    order = np.lexsort((np.concatenate((np.ones(len(starts)), np.zeros(len(ends)))), places))
    chars, owner = np.insert(chars, places[order], marks[order]), np.insert(owner, places[order], whose[order])
    code = (chars + np.uint32(1)) * np.uint32(0x9E3779B1)
    rolled, out_word, out_row = code, [], []
    for size in range(2, max(GRAMS) + 1):
        if len(code) < size:
            break
        rolled = rolled[:-1] * np.uint32(0x01000193) + code[size - 1 :]
        if size in GRAMS:
            inside = owner[: len(rolled)] == owner[size - 1 :]
            value = rolled ^ (rolled >> np.uint32(15))
            out_word.append(owner[: len(rolled)][inside])
            out_row.append(((value * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))[inside].astype(np.int64))
    at = np.searchsorted(lexicon, hashes)
    known = np.flatnonzero(lexicon[np.minimum(at, len(lexicon) - 1)] == hashes) if len(lexicon) else np.zeros(0, np.int64)
    out_word.append(known)
    out_row.append(((hashes[known] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out_word), np.concatenate(out_row)


def emissions(features: tuple[np.ndarray, np.ndarray], words: int, weights: np.ndarray) -> np.ndarray:
    word, row = features
    return np.stack([np.bincount(word, weights[row, k], minlength=words) for k in range(weights.shape[1])], axis=1)


class Marginals(NamedTuple):
    words: np.ndarray  # (words, languages) posterior probabilities
    switches: np.ndarray  # expected transitions
    starts: np.ndarray  # distribution of the first word of each text


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, expected: bool = False) -> Marginals:
    """Posterior marginals of sequences that stand one after another in ``scores``; each has a word or more."""
    n, k = scores.shape
    a = np.exp(transitions - transitions.max())
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    counts = -(-lengths // SEGMENT)
    text = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(np.cumsum(lengths) - lengths, counts) + number * SEGMENT
    size = np.minimum(SEGMENT, np.repeat(lengths, counts) - number * SEGMENT)
    order = np.argsort(-size, kind="stable")
    begin, size, text, number = begin[order], size[order], text[order], number[order]
    longest = int(size.max())
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    # Transfer matrix of every segment: the first word of a text has no transition before it.
    step_in = np.where((number == 0)[:, None, None], np.eye(k), a)
    transfer = step_in * psi[begin][:, None, :]
    transfer /= transfer.sum(axis=(1, 2), keepdims=True)
    for t in range(1, longest):
        m = active[t]
        moved = (transfer[:m].reshape(-1, k) @ a).reshape(m, k, k) * psi[begin[:m] + t][:, None, :]
        transfer[:m] = moved / moved.sum(axis=(1, 2), keepdims=True)
    # Chain the segments of each text, forwards and backwards.
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.cumsum(counts) - counts
    into, after = np.empty((len(order), k)), np.empty((len(order), k))
    state = np.full((len(lengths), k), 1.0 / k)
    for s in range(int(counts.max())):
        own = np.flatnonzero(counts > s)
        at = place[first[own] + s]
        into[at] = state[own]
        state[own] = np.einsum("ni,nij->nj", state[own], transfer[at])
        state[own] /= state[own].sum(axis=1, keepdims=True)
    state = np.full((len(lengths), k), 1.0 / k)
    for s in range(int(counts.max()) - 1, -1, -1):
        own = np.flatnonzero(counts > s)
        at = place[first[own] + s]
        after[at] = state[own]
        state[own] = np.einsum("nij,nj->ni", transfer[at], state[own])
        state[own] /= state[own].sum(axis=1, keepdims=True)
    # Inside the segments, all side by side.
    forward = np.empty((n, k))
    value = np.einsum("ni,nij->nj", into, step_in) * psi[begin]
    value /= value.sum(axis=1, keepdims=True)
    forward[begin] = value
    for t in range(1, longest):
        m = active[t]
        value = (value[:m] @ a) * psi[begin[:m] + t]
        value /= value.sum(axis=1, keepdims=True)
        forward[begin[:m] + t] = value
    words = np.empty((n, k))
    switches = np.zeros((k, k))
    backward = after.copy()
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at = begin[:m] + t
        both = forward[at] * backward[:m]
        words[at] = both / both.sum(axis=1, keepdims=True)
        ahead = psi[at] * backward[:m]
        if expected:
            linked = np.ones(m, bool) if t else number[:m] > 0
            before, later = forward[at[linked] - 1], ahead[linked]
            norm = np.einsum("ni,ij,nj->n", before, a, later)
            switches += (before / norm[:, None]).T @ later * a
        if t:
            value = ahead @ a.T
            backward[:m] = value / value.sum(axis=1, keepdims=True)
    heads = np.cumsum(lengths) - lengths
    return Marginals(words, switches, words[heads])


def lower_words(hasher: Hasher, texts: list[str]):
    raw, offsets = column_bytes(pa.array([t.lower() for t in texts], pa.string()))
    return hasher.words(raw, offsets)


def distinct_words(words) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    hashes, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
    return hashes, [words.data[words.start[i] : words.end[i]].tobytes() for i in at], inverse


def fit_languages(sample: list[tuple[str, str]], seed: int = 7) -> dict:
    """The model from (lang, text) pairs: languages, lexicon, weights and transitions; bounded in size."""
    names = sorted({lang for lang, _ in sample})
    words = lower_words(Hasher(), [text for _, text in sample])
    if not names or not len(words.hashes):
        return {"names": [], "lexicon": np.zeros(0, np.uint64), "weights": None, "transitions": None}
    hashes, spelled, inverse = distinct_words(words)
    counts = np.bincount(inverse, minlength=len(hashes))
    lexicon = hashes[counts >= LEXICON_COUNT]
    features = word_features(spelled, hashes, lexicon)
    # Runs of words of one text, dealt out to mixed sequences.
    runs = [(names.index(lang), p, min(p + RUN, int(b))) for (lang, _), a, b in zip(sample, words.first, words.first[1:]) for p in range(int(a), int(b), RUN)]
    np.random.default_rng(seed).shuffle(runs)
    used = np.concatenate([np.arange(a, b) for _, a, b in runs])
    gold = np.concatenate([np.full(b - a, label) for label, a, b in runs])
    sizes = np.array([b - a for _, a, b in runs])
    lengths = np.add.reduceat(sizes, np.arange(0, len(sizes), SEQUENCE_RUNS))
    word = inverse[used]
    k = len(names)
    target = np.eye(k)[gold]
    heads = np.zeros(len(gold), bool)
    heads[np.cumsum(lengths) - lengths] = True
    inner = np.flatnonzero(~heads)
    observed = np.zeros((k, k))
    np.add.at(observed, (gold[inner - 1], gold[inner]), 1)
    balance = np.bincount(gold, minlength=k).astype(float)
    balance = (len(gold) / k / balance)[gold][:, None]  # languages count alike
    weights, transitions = np.zeros((1 << BITS, k)), np.zeros((k, k))
    first, second = np.zeros((1 << BITS) * k + k * k), np.zeros((1 << BITS) * k + k * k)
    for step in range(1, STEPS + 1):
        found = forward_backward(emissions(features, len(hashes), weights)[word], lengths, transitions, expected=True)
        error = (found.words - target) * balance / len(gold)
        by_word = np.stack([np.bincount(word, error[:, c], minlength=len(hashes)) for c in range(k)], axis=1)
        slope = np.stack([np.bincount(features[1], by_word[features[0], c], minlength=1 << BITS) for c in range(k)], axis=1) + RIDGE * weights
        slope = np.concatenate((slope.ravel(), ((found.switches - observed) / len(gold)).ravel()))
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        weights -= move[: weights.size].reshape(weights.shape)
        transitions -= move[weights.size :].reshape(k, k)
    return {"names": names, "lexicon": lexicon, "weights": weights, "transitions": transitions}


def word_languages(model: dict, texts: list[str]) -> list[list[tuple[str, str, float]]]:
    """(word, language, probability) of every word of each text: the labels of code-switched text."""
    words = lower_words(Hasher(), texts)
    lengths = np.diff(words.first)
    hashes, spelled, inverse = distinct_words(words)
    own = lengths[lengths > 0]
    out: list[list[tuple[str, str, float]]] = [[] for _ in texts]
    if not len(own) or not model["names"]:
        return out
    found = forward_backward(emissions(word_features(spelled, hashes, model["lexicon"]), len(hashes), model["weights"])[inverse], own, model["transitions"]).words
    for d, (a, b) in enumerate(zip(words.first, words.first[1:])):
        best = found[a:b].argmax(axis=1)
        out[d] = [(spelled[inverse[i]].decode("utf-8", "replace"), model["names"][best[i - a]], float(found[i, best[i - a]])) for i in range(a, b)]
    return out


def _labels(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names, k = model["names"], len(model["names"])
        hasher = Hasher()
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            means = np.zeros((len(batch), max(k, 1)))
            held, rows = [], []

            def flush():
                if held:
                    lengths = np.concatenate([h[1] for h in held])
                    found = forward_backward(np.concatenate([h[0] for h in held]), lengths, model["transitions"]).words
                    heads = np.cumsum(lengths) - lengths
                    means[np.concatenate(rows)] = np.add.reduceat(found, heads, axis=0) / lengths[:, None]
                held.clear(), rows.clear()

            for lo, hi in slices(offsets) if k else ():
                words = hasher.words(raw, offsets[lo : hi + 1])
                lengths = np.diff(words.first)
                own = np.flatnonzero(lengths)
                if len(own):
                    hashes, spelled, inverse = distinct_words(words)
                    held.append((emissions(word_features(spelled, hashes, model["lexicon"]), len(hashes), model["weights"])[inverse], lengths[own]))
                    rows.append(lo + own)
                if sum(len(h[0]) for h in held) >= GROUP_WORDS:
                    flush()
            flush()
            best = means.argmax(axis=1)
            known = np.array(batch.column(2).to_pylist(), bool) & (k > 0)
            langs = [names[b] if is_known else NONE for b, is_known in zip(best, known)]
            score = np.where(known, np.clip(means[np.arange(len(batch)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def training_sample(docs: DataFrame, modulus: int, held_out: int) -> list[tuple[str, str]]:
    """(lang, text) of the sampled rows, long texts as excerpts; only the sampled ids are broadcast."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    own = own.where(F.col("lang").isNotNull() & (fold("doc_id", modulus) != held_out)).groupBy("doc_id").agg(F.min("lang").alias("lang"))
    sample = hash_sample(own, SAMPLE, "lang", "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("text is not null").join(F.broadcast(sample), "doc_id")
    rows = texts.withColumn("text", excerpt("text", "doc_id", SAMPLE_BYTES)).collect()
    return [(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))]


def language_id(docs: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    Learned from rows with a non-null lang and ``crc32(doc_id) % modulus != held_out``; only the text decides
    a prediction. ``score`` is the mean probability of the predicted language over the words. Texts that are
    null or without a letter get ``und`` and 0, as all texts do if there is nothing to learn from. A null
    doc_id is labelled and has a null fold; repeated rows are labelled each; ties go to the language that
    sorts first. An empty table gives an empty result; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_languages(training_sample(docs, modulus, held_out)))
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(text).alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    labelled = rows.mapInArrow(_labels(model), "doc_id long, lang_pred string, score double")
    return labelled.select("doc_id", (fold("doc_id", modulus) == held_out).alias("held_out"), "lang_pred", "score")
