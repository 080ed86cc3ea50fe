"""Near-duplicate vectors of one label, exactly, by PCA-ordered tiled comparison.

Unit vectors are rotated onto the principal axes (fitted on at most ``PCA_SAMPLE`` vectors; the rotation
only orders the work and never decides a link). The vectors of a label are cut into tiles of about
``TILE`` along the first axis; two tiles are compared only if their ranges on it are near enough. In a
pair of tiles the products are summed axis by axis group, and a pair of vectors is given up as soon as its
sum so far plus the product of the suffix norms cannot reach the threshold. What is left is confirmed with
the cosine of the original vectors in double precision.

Equal vectors of a label are one representative with a weight, so copies are never compared. A pair of
tiles returns link counts and a spanning star of its links, at most one row per vector, not the pairs.
Each pair of tiles is a task of bounded size, so a hot label spreads over as many tasks as it has pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kithwork.llm.components import components
from kithwork.llm.tables import stored
from kithwork.llm.words import mix

THRESHOLD = 0.93
TILE = 1024
CELL = 0.01
PCA_SAMPLE = 5000
FIRST_AXES = 8
SLACK = 1e-9
VECTORS = "vec_id long, label long, dim int, d1 long, d2 long, unit array<double>"


def vector_digest(x: np.ndarray) -> tuple[int, int]:
    bits = (x + 0.0).view(np.uint64)
    place = np.arange(1, len(x) + 1, dtype=np.uint64)
    both = (mix(bits + place * np.uint64(c)).sum(dtype=np.uint64) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
    return tuple(int(v.view(np.int64)) for v in both)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors of the valid rows; the others have a null ``unit``."""
    for batch in batches:
        dims, firsts, seconds, units = [], [], [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            x = np.array(vector, np.float64) if vector and label is not None and None not in vector else np.zeros(0)
            largest = np.abs(x).max() if len(x) else 0.0
            if not len(x) or not np.isfinite(largest) or largest == 0:
                dims.append(None), firsts.append(None), seconds.append(None), units.append(None)
                continue
            scaled = x / largest
            d1, d2 = vector_digest(x)
            dims.append(len(x)), firsts.append(d1), seconds.append(d2), units.append(scaled / np.sqrt(scaled @ scaled))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64()), pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "label", "dim", "d1", "d2", "unit"],
        )


def principal_axes(sample: list[np.ndarray]) -> np.ndarray:
    """Orthogonal axes as columns, the one with the largest spread first."""
    x = np.array(sample)
    _, axes = np.linalg.eigh(np.cov(x, rowvar=False).reshape(x.shape[1], x.shape[1]) if len(x) > 1 else np.eye(x.shape[1]))
    return axes[:, ::-1]


def _rotate(axes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, units = batch.column(2).to_pylist(), batch.column(3)
            turned = [np.asarray(u, np.float64) @ axes.value[d] for d, u in zip(dims, units.to_pylist())]
            first = pa.array([t[0] for t in turned], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(turned, pa.list_(pa.float64())), first], names=["rep", "label", "dim", "unit", "weight", "turned", "z"])

    return run


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) whose products can reach the threshold, bounded by suffix norms as the axes add up."""
    dim = a.shape[1]
    stops = [0]
    while stops[-1] < dim:
        stops.append(min(dim, stops[-1] * 2 or FIRST_AXES))
    suffix = [[np.sqrt((x[:, s:] ** 2).sum(axis=1)) for x in (a, b)] for s in stops]
    total = np.zeros((len(a), len(b)))
    pairs = None
    for k in range(1, len(stops)):
        axes, (left, right) = slice(stops[k - 1], stops[k]), suffix[k]
        if pairs is None:
            total += a[:, axes] @ b[:, axes].T
            alive = total + left[:, None] * right[None, :] >= threshold - SLACK
            if alive.mean() < 0.05 or k == len(stops) - 1:
                pairs = np.nonzero(alive)
                sums = total[pairs]
        else:
            kept_i, kept_j, kept = [], [], []
            for at in range(0, len(pairs[0]), 1 << 18):
                i, j = pairs[0][at : at + (1 << 18)], pairs[1][at : at + (1 << 18)]
                s = sums[at : at + (1 << 18)] + np.einsum("ij,ij->i", a[i, axes], b[j, axes])
                alive = s + left[i] * right[j] >= threshold - SLACK
                kept_i.append(i[alive]), kept_j.append(j[alive]), kept.append(s[alive])
            pairs = tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (kept_i, kept_j))
            sums = np.concatenate(kept) if kept else np.zeros(0)
    return pairs


def star_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable over the edges (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == before).all():
            return root


def _compare(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group["rep"].to_numpy(), kind="stable")
        rep, tile, weight = (group[c].to_numpy()[order] for c in ("rep", "tile", "weight"))
        dim = group["dim"][0].as_py()
        turned, unit = (group[c].combine_chunks().flatten().to_numpy().reshape(-1, dim)[order] for c in ("turned", "unit"))
        lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
        left, right = np.flatnonzero(tile == lo), np.flatnonzero(tile == hi)
        i, j = linked_pairs(turned[left], turned[right], threshold)
        i, j = left[i], right[j]
        if lo == hi:
            i, j = i[i < j], j[i < j]
        if len(i):
            sure = np.concatenate([np.einsum("ij,ij->i", unit[i[at : at + (1 << 18)]], unit[j[at : at + (1 << 18)]]) for at in range(0, len(i), 1 << 18)])
            i, j = i[sure >= threshold], j[sure >= threshold]
        links = np.bincount(i, weight[j], minlength=len(rep)) + np.bincount(j, weight[i], minlength=len(rep))
        root = star_roots(len(rep), i, j)
        found = np.flatnonzero(links)
        return pa.table({"rep": rep[found], "links": links[found].astype(np.int64), "root": rep[root[found]]})

    return run


def tiled(vectors: DataFrame, threshold: float, tile_rows: int = TILE) -> DataFrame:
    """(.., tile) and the pairs of tiles (lo, hi) each row takes part in, per label and dimension."""
    key = ["label", "dim"]
    cells = vectors.withColumn("cell", F.floor(F.col("z") / CELL).cast("int"))
    sizes = cells.groupBy(*key, "cell").agg(F.count("*").alias("n"), F.min("z").alias("z_lo"), F.max("z").alias("z_hi"))
    parts = sizes.withColumn("splits", F.ceil(F.col("n") / tile_rows).cast("int"))
    # A cell above the size of a tile is cut by hash into tiles of its own; the others are put together.
    running = Window.partitionBy(*key).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = F.floor((F.sum("n").over(running) - F.col("n")) / tile_rows)
    parts = parts.withColumn("slot", F.when(F.col("splits") > 1, F.struct(F.col("cell").cast("long").alias("a"), F.lit(1).alias("b"))).otherwise(F.struct(group.alias("a"), F.lit(0).alias("b"))))
    parts = stored(parts, "cells")
    slots = parts.groupBy(*key, "slot").agg(F.min("z_lo").alias("z_lo"), F.max("z_hi").alias("z_hi"), F.max("splits").alias("splits"))
    tiles = slots.withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    tiles = stored(tiles.withColumn("tile", F.row_number().over(Window.partitionBy(*key).orderBy("slot", "split"))), "tiles")
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    other = tiles.select(*key, F.col("tile").alias("hi"), F.col("z_lo").alias("o_lo"), F.col("z_hi").alias("o_hi"))
    pairs = tiles.select(*key, F.col("tile").alias("lo"), "z_lo", "z_hi").join(other, key)
    pairs = pairs.where((F.col("lo") <= F.col("hi")) & (F.col("o_lo") - F.col("z_hi") <= reach) & (F.col("z_lo") - F.col("o_hi") <= reach)).select(*key, "lo", "hi")
    ends = pairs.select(*key, F.col("lo").alias("tile"), "lo", "hi").unionByName(pairs.where("lo <> hi").select(*key, F.col("hi").alias("tile"), "lo", "hi"))
    rows = cells.join(parts.select(*key, "cell", "slot", "splits"), [*key, "cell"])
    rows = rows.withColumn("split", F.pmod(F.xxhash64("rep"), F.col("splits")).cast("int")).drop("splits", "cell")
    rows = rows.join(tiles.select(*key, "slot", "split", "tile"), [*key, "slot", "split"]).drop("slot", "split")
    return rows.join(ends, [*key, "tile"])


def embedding_dedup(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vec_id of ``embeddings`` (vec_id, embedding, label).

    Two vectors are linked if their labels are equal, not null, and their cosine is at least ``threshold``.
    Null, empty and zero vectors, vectors with null or non-finite components and rows without label link
    with nothing, nor do vectors of different length. Rows without vec_id have no row in the result; of
    rows that repeat one the smallest (label, embedding) counts. Ties: the smallest id of a component is
    kept. An empty table gives an empty result; other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding")
    vectors = stored(rows.mapInArrow(_units, VECTORS), "vectors")
    copies = ["label", "dim", "d1", "d2"]
    reps = vectors.where("unit is not null").groupBy(*copies).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.min_by("unit", "vec_id").alias("unit"))
    reps = stored(reps, "representatives")
    axes = {}
    for row in reps.select("dim").distinct().collect():
        sample = reps.where(F.col("dim") == row["dim"]).orderBy(F.xxhash64("rep")).limit(PCA_SAMPLE).select("unit").collect()
        axes[row["dim"]] = principal_axes([r["unit"] for r in sample])
    turned = reps.select("rep", "label", "dim", "unit", "weight").mapInArrow(
        _rotate(embeddings.sparkSession.sparkContext.broadcast(axes)), "rep long, label long, dim int, unit array<double>, weight long, turned array<double>, z double"
    )
    rows = tiled(stored(turned, "turned"), threshold)
    found = rows.groupBy("label", "dim", "lo", "hi").applyInArrow(_compare(threshold), "rep long, links long, root long")
    found = stored(found, "links")
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.select(*copies, "rep", "weight").join(links, "rep", "left").join(linked, F.col("rep") == F.col("id"), "left")
    classes = classes.select(*copies, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    result = vectors.drop("unit").join(classes, copies, "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
