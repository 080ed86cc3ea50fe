"""Near-duplicate documents by MinHash with tensored banding, every link confirmed on the full shingle sets.

A table key would need ``2 * HALF`` minhashes of its own. Here a document computes two collections of
``SIDE`` parts of ``HALF`` minhashes each, and the key of table (i, j) is the pair of part i of the first
and part j of the second collection: SIDE * SIDE = 144 tables from 96 minhashes instead of 1152. A pair of
similarity s shares a key with probability (1 - (1 - s**HALF)**SIDE)**2: 0.9997 at 0.85, 0.99999 at 0.9.
Below 85 percent ``sides`` takes more parts, so that the probability at the threshold is 0.9997 again.

1. One pass makes a sketch per document: set size, 128-bit digest of the set, the parts.
2. Documents with equal sets become one representative, the smallest id.
3. Parts held by one representative only are dropped; the keys of the rest are built from pairs of parts.
4. Every key links its representatives to the smallest one; the components of these links are clumps. Two
   documents with a common key are always in one clump.
5. Whole texts meet clump by clump: small clumps share a task, a large one is cut into tiles and every pair
   of tiles is a task of its own. Exact intersections are counted for all pairs of a task, and only a
   spanning star of the confirmed links leaves it. Components of the confirmed links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kithwork.llm.components import components
from kithwork.llm.tables import few_tasks, matching_rows, stored
from kithwork.llm.words import Hasher, column_bytes, lean, mix, shingle_hashes, slices

SHINGLE = 5
PERCENT = 85
SIDE = 12
HALF = 4
TILE_DOCS = 1024
TILE_SHINGLES = 250_000
# Table keys that one task writes, at most one for each document and table.
TASK_KEYS = 2_000_000
TASK_SKETCHES = 20_000

SKETCH = "doc_id long, n_shingles long, d1 long, d2 long, parts array<long>"
MISSED = 0.0003


def sides(percent: int) -> int:
    """Parts of a collection: SIDE, or as many as miss a pair at the threshold with probability MISSED at most."""
    if percent <= 0:
        raise ValueError("percent must be positive")
    side, s = SIDE, percent / 100
    while percent < PERCENT and 1 - (1 - (1 - s**HALF) ** side) ** 2 > MISSED:
        side += 1
    return side


@lru_cache
def twists(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(20240229))
    return random.integers(1, 1 << 63, n, dtype=np.uint64), random.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(shingles: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    twist, factor = twists(n)
    for at in range(0, len(shingles), 2048):
        block = (shingles[None, at : at + 2048] ^ twist[:, None]) * factor[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def banding_parts(shingles: np.ndarray, side: int = SIDE) -> np.ndarray:
    """One value per part; its number is mixed in, so parts of different numbers never meet."""
    least = minhashes(shingles, 2 * side * HALF).reshape(2 * side, HALF)
    value = np.arange(2 * side, dtype=np.uint64)
    for k in range(HALF):
        value = mix(value + least[:, k])
    return value.view(np.int64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    both = mix(shingles), mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    return tuple(int(x.sum(dtype=np.uint64).view(np.int64)) for x in both)


def _sketches(size: int, side: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            raw, offsets = column_bytes(batch.column(1))
            sizes, firsts, seconds, parts = [], [], [], []
            for a, b in slices(offsets):
                for shingles in shingle_hashes(hasher.words(raw, offsets[a : b + 1]), size):
                    d1, d2 = digest(shingles)
                    sizes.append(len(shingles)), firsts.append(d1), seconds.append(d2)
                    parts.append(banding_parts(shingles, side) if len(shingles) else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                names=["doc_id", "n_shingles", "d1", "d2", "parts"],
            )

    return run


def sketches(docs: DataFrame, size: int = SHINGLE, side: int = SIDE) -> DataFrame:
    """One row per doc_id; of rows with the same id the one with the smallest sketch."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.where(F.col("doc_id").isNotNull()).mapInArrow(lean(_sketches(size, side)), SKETCH)
    return made.groupBy("doc_id").agg(F.min(F.struct("n_shingles", "d1", "d2", "parts")).alias("s")).select("doc_id", "s.*")


def candidate_stars(reps: DataFrame, side: int = SIDE) -> tuple[DataFrame, int]:
    """(a, b): for every table key with several documents, each of them with the smallest; and how many rows at most."""
    first_side = F.col("at") < side
    parts = reps.select("rep", F.posexplode("parts").alias("at", "part"))
    shared = parts.groupBy("part").count().where("count > 1").select("part")
    held = parts.join(shared, "part", "left_semi").groupBy("rep").agg(
        F.collect_list(F.when(first_side, F.col("part"))).alias("us"), F.collect_list(F.when(~first_side, F.col("part"))).alias("vs")
    )
    keys = held.select("rep", "vs", F.explode("us").alias("u")).select("rep", "u", F.explode("vs").alias("v"))
    keys = stored(few_tasks(keys.select(F.xxhash64("u", "v").alias("key"), "rep"), reps.count(), TASK_KEYS // side**2), "keys")
    first = keys.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    return keys.join(first, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), keys.count()


def intersections(sets: list[np.ndarray], dense_from: int = 32) -> np.ndarray:
    """Exact sizes of all pairwise intersections.

    Shingles held by many sets are counted by a product of 0/1 matrices, the others pair by pair.
    """
    n = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    held = np.diff(np.append(first, len(flat)))
    common = np.zeros(n * n, np.int64)
    for c in range(2, dense_from):
        at = first[held == c]
        if len(at):
            members = owner[at[:, None] + np.arange(c)]
            for i in range(c - 1):
                common += np.bincount((members[:, i, None] * n + members[:, i + 1 :]).ravel(), minlength=n * n)
    common = common.reshape(n, n)
    common += common.T.copy()
    at, counts = first[held >= dense_from], held[held >= dense_from]
    for lo in range(0, len(at), 4096):
        part = counts[lo : lo + 4096]
        rows = np.concatenate([owner[a : a + c] for a, c in zip(at[lo : lo + 4096], part)])
        block = np.zeros((n, len(part)), np.float32)
        block[rows, np.repeat(np.arange(len(part)), part)] = 1
        common += (block @ block.T).astype(np.int64)
    np.fill_diagonal(common, [len(s) for s in sets])
    return common


def linked_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest position reachable over a symmetric boolean matrix."""
    n = len(linked)
    root = np.arange(n)
    linked = linked | np.eye(n, dtype=bool)
    while True:
        least = np.where(linked, root[None, :], n).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root
        root = least


def _confirm(size: int, percent: int):
    def run(group: pa.Table) -> pa.Table:
        hasher = Hasher()
        raw, offsets = column_bytes(group["text"])
        sets = [s for a, b in slices(offsets) for s in shingle_hashes(hasher.words(raw, offsets[a : b + 1]), size)]
        clump, rep, tile = (group[c].to_numpy() for c in ("clump", "rep", "tile"))
        lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
        same = [digest(s) == (d1, d2) for s, d1, d2 in zip(sets, group["d1"].to_pylist(), group["d2"].to_pylist())]
        order = [i for i in np.lexsort((rep, clump)) if same[i]]
        out_a, out_b = [], []
        at = 0
        while at < len(order):
            stop = at
            members = []
            while stop < len(order) and clump[order[stop]] == clump[order[at]]:
                if not members or rep[members[-1]] != rep[order[stop]]:
                    members.append(order[stop])
                stop += 1
            at = stop
            if len(members) < 2:
                continue
            own = [sets[i] for i in members]
            common = intersections(own)
            sizes = np.array([len(s) for s in own])
            linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
            if lo != hi:
                linked &= tile[members][:, None] != tile[members][None, :]
            root = linked_roots(linked)
            ids = rep[members]
            moved = root != np.arange(len(root))
            out_a.append(ids[root[moved]]), out_b.append(ids[moved])
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *out_a]), "b": np.concatenate([none, *out_b])})

    return run


def confirmed_links(docs: DataFrame, reps: DataFrame, clumps: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): a spanning star of the confirmed links of every task."""
    held = clumps.select(F.col("id").alias("rep"), F.col("component").alias("clump")).join(reps.select("rep", "n_shingles", "d1", "d2"), "rep")
    stats = held.groupBy("clump").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    tiles = F.ceil(F.greatest(F.col("n") / TILE_DOCS, F.col("total") / TILE_SHINGLES)).cast("int")
    held = stored(few_tasks(held.join(stats.select("clump", tiles.alias("tiles")), "clump"), clumps.count()), "clumps")
    small, total = held.agg(F.sum(F.when(F.col("tiles") == 1, F.col("n_shingles"))), F.sum("n_shingles")).first()
    bins = 1 + (small or 0) // TILE_SHINGLES
    held = held.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    rows = matching_rows(texts, held.where("tiles >= 1"), "rep", "texts", (total or 0, TILE_SHINGLES))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select(
        "clump", "rep", "tile", "d1", "d2", "text", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
        F.when(F.col("tiles") == 1, -1 - F.pmod(F.xxhash64("clump"), F.lit(bins))).otherwise(F.col("clump")).alias("task"),
    )
    return rows.groupBy("task", "lo", "hi").applyInArrow(_confirm(size, percent), "a long, b long")


def minhash_dedup(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every doc_id of ``docs`` (doc_id, text).

    Links have ``100 * intersection >= percent * union`` of distinct ``size``-word shingles of the text with
    A-Z lower-cased. Null or empty texts and texts without words have no shingles and link with nothing;
    1 to size - 1 words are one shingle. Rows without id have no row in the result; an id that is repeated
    has one. Ties: the smallest id of a component is kept. Other columns are not read. An empty table gives
    an empty result.
    """
    side = sides(percent)
    sketch = stored(sketches(docs, size, side), "sketches")
    reps = sketch.where("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("parts").alias("parts")
    )
    reps = stored(few_tasks(reps, sketch.count(), TASK_SKETCHES), "sets")
    stars, most = candidate_stars(reps, side)
    clumps = components(stars, most=most)
    linked = components(confirmed_links(docs, reps, clumps, size, percent))
    classes = reps.select("d1", "d2", "rep").join(linked, F.col("rep") == F.col("id"), "left")
    classes = classes.select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    rows = sketch.drop("parts").join(classes, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
