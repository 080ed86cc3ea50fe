"""Half-rounds of alternating least squares on ratings packed as arrays.

Ids are dealt to groups and numbered in them, once. A cell holds the ratings between a group of one side and a group
(block) of the other side as arrays of places, sorted by the id that is solved for; the factors of a group are one
array. A half-round is one task per group: it holds the group's cells, reads the blocks of factors one after another,
adds the k x k products of its ids and solves them, which gives the next block. Nothing is shuffled, but for hot ids:
those have a group of their own, a task per block adds their sums, and one more task adds these and solves.

Groups are as many as bound what a task holds: the sums and the ratings of its ids, and one block of factors.
"""

from __future__ import annotations

import pickle
import sys
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import partial, reduce
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kithwork.session import cut_lineage, settings, shared_folder

# As in ``kithwork.llm``, executors need numpy and pyarrow but not this package.
register_pickle_by_value(sys.modules[__name__])

# What a group holds at most, on average: bytes of sums, and ratings (9 bytes each).
SUM_BYTES = 64_000_000
GROUP_RATINGS = 12_000_000
# A group has no fewer ratings than this, unless there is only one.
LEAST_RATINGS = 200_000
# Ratings that are dealt to cells together, and that a row of a cell has at most.
CELL_RATINGS = 1_000_000
# Ratings that are multiplied together, few enough for a processor's own memory.
SLICE = 1 << 16
# Ids made into rows together.
UNPACKED = 10_000
# Bits of an id's state: it has factors, and they are not null.
FOUND, RATED = 1, 2
# Rows that hold arrays go to Python one by one, and a union keeps the tasks of its sides apart.
ROW_BY_ROW = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
}
PACKED = "slot int, block int, data binary"
# A writer or a reader of such rows holds a row group: few rows, checked one by one, each megabytes long.
FEW_ROWS = {
    "parquet.block.size": "16000000",
    "parquet.enable.dictionary": "false",
    **{f"parquet.{of}.size.row.check.{end}": "1" for of in ("block", "page") for end in ("min", "max")},
}
# Slots of rows that hold the factors, or the ids, of a block.
FACTORS, IDS = -1, -2

_numbers: dict[int, list[int]] = {}


class Side(NamedTuple):
    """The ids of one side: ``groups`` groups by hash, and one more of the hot ids, sorted."""

    key: str
    groups: int
    hot: list
    first: int  # the first slot
    blocks: int  # groups of the other side, the hot one counted

    @property
    def slots(self) -> int:
        """A slot for every group, and one for the hot ids' ratings in every block."""
        return self.groups + 1 + self.blocks

    def slot(self, group: np.ndarray | int, block: np.ndarray | int):
        return self.first + np.where(group == self.groups, self.groups + 1 + block, group)

    def group(self) -> Column:
        dealt = F.pmod(F.xxhash64(self.key), F.lit(self.groups)).cast("int")
        return F.when(F.col(self.key).isin(self.hot), F.lit(self.groups)).otherwise(dealt) if self.hot else dealt


def width(k: int) -> int:
    return k * (k + 3) // 2


def groups(ratings: int, ids: int, k: int, tasks: int) -> int:
    """As many as bound their sums and ratings, else as many as tasks run at once, if they have enough to do."""
    least = max(-(-ids * width(k) * 8 // SUM_BYTES), -(-ratings // GROUP_RATINGS))
    if least > tasks:
        return -(-least // tasks) * tasks
    return max(1, least, min(tasks, ratings // LEAST_RATINGS))


def block_numbers(spark: SparkSession, tasks: int) -> list[int]:
    """One number for every task, such that partitioning by the number deals one block to each."""
    if tasks not in _numbers:
        numbers = spark.range(64 * tasks).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("task")).agg(F.min("id").alias("number"))
        _numbers[tasks] = [r["number"] for r in numbers.orderBy("task").collect()]
    return _numbers[tasks]


def _dealt(df: DataFrame, by: str, count: int) -> DataFrame:
    """``df`` with one task for every value of ``by``, which is below ``count``."""
    numbers = F.lit(block_numbers(df.sparkSession, count)).cast("array<bigint>")
    return df.repartition(count, F.get(numbers, F.col(by)))


# ---- ids and their places


def _packed_row(slot: int, block: int, data) -> pa.RecordBatch:
    row = [pa.array([slot], pa.int32()), pa.array([block], pa.int32()), pa.array([pickle.dumps(data, 5)], pa.binary())]
    return pa.RecordBatch.from_arrays(row, ["slot", "block", "data"])


def _pack_ids(batches: Iterator[pa.RecordBatch], key: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The ids of every group in order of their places, or, where ``names`` are given, their factors."""
    found = defaultdict(list)
    for batch in batches:
        of = batch.column("group").to_numpy()
        for g in np.unique(of).tolist():
            rows = batch.filter(pa.array(of == g))
            if names:
                found[g].append(np.stack([rows.column(n).fill_null(0.0).to_numpy() for n in names], axis=1))
            else:
                found[g].append(rows.column(key))
    for g, parts in found.items():
        if names:
            factors = np.concatenate(parts)
            yield _packed_row(FACTORS, g, (factors, np.full(len(factors), FOUND | RATED, np.uint8)))
        else:
            yield _packed_row(IDS, g, pa.concat_arrays(parts))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Buffer]]:
    for batch in batches:
        for slot, block, data in zip(*(batch.column(n) for n in ("slot", "block", "data"))):
            yield slot.as_py(), block.as_py(), data.as_buffer()


# ---- cells


class Cell(NamedTuple):
    """Ratings by place of both ids; ``values[code]`` is the rating, but where ``code`` is ``null``."""

    place: np.ndarray
    by: np.ndarray
    codes: np.ndarray
    values: np.ndarray
    null: int


class Rows(NamedTuple):
    """Ratings by group and place of the item (``g``, ``p``) and the user (``h``, ``q``); ids stand for places not yet known.

    ``values[code]`` is the rating; the last code stands for null. Of a null id the place is -1 instead of 0.
    """

    g: np.ndarray
    h: np.ndarray
    p: np.ndarray | pa.Array
    q: np.ndarray | pa.Array
    codes: np.ndarray
    values: np.ndarray

    def take(self, at: np.ndarray) -> Rows:
        return Rows(*(x[at] if isinstance(x, np.ndarray) else x.take(pa.array(at)) for x in self[:-1]), self.values)

    def split(self, name: str) -> Iterator[tuple[int, Rows]]:
        group = getattr(self, name)
        order = np.argsort(group, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            yield int(group[at[0]]), self.take(at)


def _joined(parts: list[np.ndarray | pa.Array]) -> np.ndarray | pa.Array:
    return np.concatenate(parts) if isinstance(parts[0], np.ndarray) else pa.concat_arrays(parts)


def _codes(codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    return codes.astype(np.uint8 if len(values) <= 256 else np.int32)


def _recoded(codes: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of several tables of values as codes of one."""
    ends = np.cumsum([len(v) for v in values])
    every = np.concatenate(values)
    null = np.zeros(len(every), bool)
    null[ends - 1] = True
    distinct, number = np.unique(every[~null], return_inverse=True)
    values_of = np.append(distinct, 0.0)
    new = np.full(len(every), len(distinct))
    new[~null] = number
    parts = [_codes(new[end - len(v) : end], values_of)[c] for c, v, end in zip(codes, values, ends)]
    return np.concatenate(parts), values_of


def _places(keys: pa.Array, ids: pa.Array) -> np.ndarray:
    places = pc.index_in(keys, value_set=ids).to_numpy(zero_copy_only=False).astype(np.int32)
    if keys.null_count:
        places[keys.is_null().to_numpy(zero_copy_only=False)] = -1
    return places


def _dealt_rows(rows: Rows, group: str, place: str, side: Side, turn: Iterator[int]) -> Iterator[pa.RecordBatch]:
    """Rows for the tasks of the groups of ``side``; those of hot ids get their places here and go to any task."""
    for n, part in rows.split(group):
        if n == side.groups:
            ids = getattr(part, place)
            part = part._replace(**{place: _places(ids, pa.array(side.hot, ids.type))})
        yield _packed_row(next(turn) % side.groups if n == side.groups else n, n, tuple(part))


def _dealt_ratings(batches: Iterator[pa.RecordBatch], side: Side, other: Side) -> Iterator[pa.RecordBatch]:
    """Columns g, h, item_id, user_id and rating, as rows for the tasks of ``side``, the users."""
    buffer, size, turn = [], 0, count()
    group = np.int16 if max(side.groups, other.groups) < 1 << 15 else np.int32

    def flush() -> Iterator[pa.RecordBatch]:
        g, h, p, q, rating = (c.chunk(0) for c in pa.Table.from_batches(buffer).combine_chunks().columns)
        rating = rating.dictionary_encode()
        values = np.append(rating.dictionary.to_numpy(zero_copy_only=False), 0.0)
        codes = _codes(rating.indices.fill_null(len(values) - 1).to_numpy(zero_copy_only=False), values)
        yield from _dealt_rows(Rows(g.to_numpy().astype(group), h.to_numpy().astype(group), p, q, codes, values), "h", "q", side, turn)

    for batch in batches:
        buffer.append(batch)
        size += batch.num_rows
        if size >= CELL_RATINGS:
            yield from flush()
            buffer, size = [], 0
    if size:
        yield from flush()


def _placed(batches: Iterator[pa.RecordBatch], place: str, side: Side) -> Iterator[Rows]:
    """Rows of one group after another with the places of its ids, which come before the group's rows."""
    at, ids, parts, size = None, None, [], 0

    def flush() -> Rows:
        *arrays, codes, values = zip(*parts)
        rows = Rows(*map(_joined, arrays), *_recoded(codes, values))
        return rows if at[1] == side.groups else rows._replace(**{place: _places(getattr(rows, place), ids)})

    for slot, block, data in _rows(batches):
        if parts and ((slot, block) != at or size >= CELL_RATINGS):
            yield flush()
            parts, size = [], 0
        if block == IDS:
            ids = pickle.loads(data)
        else:
            parts.append(pickle.loads(data))
            at, size = (slot, block), size + len(parts[-1][0])
    if parts:
        yield flush()


def _dealt_again(batches: Iterator[pa.RecordBatch], side: Side, other: Side) -> Iterator[pa.RecordBatch]:
    """Rows of the tasks of ``side``, the users, for those of the items."""
    turn = count()
    for rows in _placed(batches, "q", side):
        yield from _dealt_rows(rows, "g", "p", other, turn)


def _cut(batches: Iterator[pa.RecordBatch], side: Side, other: Side) -> Iterator[pa.RecordBatch]:
    """Rows of the tasks of ``side``, the items, as cells for either side; a null id has ratings, but nobody meets it."""
    for rows in _placed(batches, "p", side):
        for a, of_item in rows.split("g"):
            for b, r in of_item.split("h"):
                for to, place, by, group, block in ((side, r.p, r.q, a, b), (other, r.q, r.p, b, a)):
                    kept = by >= 0
                    if kept.any():
                        cell = Cell(np.maximum(place[kept], 0), by[kept], r.codes[kept], r.values, len(r.values) - 1)
                        yield _packed_row(int(to.slot(group, block)), block, tuple(cell))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one cell put together, sorted by the place of the id that is solved for."""
    at, parts, size = None, [], 0

    def flush() -> pa.RecordBatch:
        codes, values = _recoded([c.codes for c in parts], [c.values for c in parts])
        place, by = (np.concatenate([c[n] for c in parts]) for n in (0, 1))
        order = np.argsort(place, kind="stable")
        null = len(values) - 1
        cell = Cell(place[order], by[order], codes[order], values, null if (codes == null).any() else -1)
        return _packed_row(*at, tuple(cell))

    for slot, block, data in _rows(batches):
        cell = Cell(*pickle.loads(data))
        if parts and ((slot, block) != at or size + len(cell.by) > CELL_RATINGS):
            yield flush()
            parts, size = [], 0
        at, size = (slot, block), size + len(cell.by)
        parts.append(cell)
    if parts:
        yield flush()


# ---- half-rounds


class Sums:
    """Sums of factor products (upper triangle) and of rating x factor, column by column, for the ids of a group."""

    def __init__(self, size: int, k: int):
        self.k, self.pairs = k, [(i, j) for i in range(k) for j in range(i, k)]
        self.sums = np.zeros((width(k), size))
        self.state = np.zeros(size, np.uint8)

    def add(self, cell: Cell, factors: np.ndarray, state: np.ndarray) -> None:
        whole = bool((state == FOUND | RATED).all())
        for s in range(0, len(cell.by), SLICE):
            place, by, codes = (x[s : s + SLICE] for x in (cell.place, cell.by, cell.codes))
            if not whole:
                of = state[by]
                self.state[place[of != 0]] |= FOUND
                known = of == FOUND | RATED
                place, by, codes = place[known], by[known], codes[known]
                if not len(by):
                    continue
            span = int(place[-1]) - int(place[0]) + 1
            if span <= 4 * len(by):
                at, local = slice(int(place[0]), int(place[0]) + span), (place - place[0]).astype(np.intp)
            else:
                new = np.append(True, place[1:] != place[:-1])
                at, local = place[new], np.cumsum(new) - 1
                span = len(at)
            f = np.ascontiguousarray(factors.take(by, axis=0).T)
            for n, (i, j) in enumerate(self.pairs):
                self.sums[n, at] += np.bincount(local, f[i] * f[j], span)
            found = np.zeros(span, np.uint8)
            found[local] = FOUND
            if cell.null >= 0:
                rated = codes != cell.null
                local, codes, f = local[rated], codes[rated], f[:, rated]
            found[local] = FOUND | RATED
            self.state[at] |= found
            rating = cell.values[codes]
            for n in range(self.k):
                self.sums[len(self.pairs) + n, at] += np.bincount(local, rating * f[n], span)

    def solve(self, regularisation: float, strict: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(A + regularisation I) x = b`` by elimination without pivoting, as ``factorize.solve`` has it.

        No rating that counts: factors are null. A pivot of zero is an error, or null where ``strict`` is not set.
        """
        k, state = self.k, self.state.copy()
        x = np.zeros((self.sums.shape[1], k))
        for s in range(0, self.sums.shape[1], SLICE):
            at = s + np.flatnonzero(state[s : s + SLICE] == FOUND | RATED)
            a = {pair: self.sums[n, at] for n, pair in enumerate(self.pairs)}
            b = [self.sums[len(self.pairs) + n, at] for n in range(k)]
            zero = np.zeros(len(at), bool)
            with np.errstate(all="ignore"):
                for i in range(k):
                    a[i, i] = a[i, i] + regularisation
                for p in range(k):
                    zero |= a[p, p] == 0
                    for i in range(p + 1, k):
                        ratio = a[p, i] / a[p, p]
                        for j in range(i, k):
                            a[i, j] = a[i, j] - ratio * a[p, j]
                        b[i] = b[i] - ratio * b[p]
                for p in reversed(range(k)):
                    known = b[p]
                    for j in range(p + 1, k):
                        known = known - a[p, j] * x[at, j]
                    x[at, p] = known / a[p, p]
            if strict and zero.any():
                raise ZeroDivisionError("the normal equations of an id have a pivot of zero")
            state[at[zero]] = FOUND
        return x, state


def _added(batches: Iterator[pa.RecordBatch], size: int, cells: int, k: int) -> Sums:
    """The sums of a group.

    Its ``cells`` rows come before the factors, which then go one block after another; also if they did not, no row
    would be missed: a cell waits for its block, and a block is kept until all cells are there.
    """
    sums, waiting, kept = Sums(size, k), defaultdict(list), {}
    for slot, block, data in _rows(batches):
        if slot == FACTORS:
            if cells:
                kept[block] = data
            met, factors = waiting.pop(block, ()), data
        else:
            cells -= 1
            met, factors = ([data], kept[block]) if block in kept else ((), None)
            if factors is None:
                waiting[block].append(data)
            if not cells:
                kept = {}
        if met:
            arrays = pickle.loads(factors)
            for cell in met:
                sums.add(Cell(*pickle.loads(cell)), *arrays)
    return sums


def _solved_group(
    batches: Iterator[pa.RecordBatch], size: int, cells: int, k: int, group: int, regularisation: float, strict: bool
) -> Iterator[pa.RecordBatch]:
    yield _packed_row(FACTORS, group, _added(batches, size, cells, k).solve(regularisation, strict))


def _part_of_sums(batches: Iterator[pa.RecordBatch], size: int, cells: int, k: int, block: int) -> Iterator[pa.RecordBatch]:
    sums = _added(batches, size, cells, k)
    yield _packed_row(0, block, (sums.sums, sums.state))


def _solved_parts(
    batches: Iterator[pa.RecordBatch], size: int, k: int, group: int, regularisation: float, strict: bool
) -> Iterator[pa.RecordBatch]:
    sums, parts = Sums(size, k), {block: data for _, block, data in _rows(batches)}
    for block in sorted(parts):
        added, state = pickle.loads(parts[block])
        sums.sums += added
        sums.state |= state
    yield _packed_row(FACTORS, group, sums.solve(regularisation, strict))


def _unpacked(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows (id, factors) of the ids of a group that have any, from its ids and its block of factors."""
    found = defaultdict(dict)
    for slot, block, data in _rows(batches):
        found[block][slot] = pickle.loads(data)
        if len(found[block]) < 2:
            continue
        ids, (factors, state) = found[block][IDS], found.pop(block)[FACTORS]
        for s in range(0, len(state), UNPACKED):
            at = s + np.flatnonzero(state[s : s + UNPACKED])
            null = np.repeat(state[at] != FOUND | RATED, factors.shape[1])
            values = pa.array(factors[at].ravel(), mask=null)
            lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * factors.shape[1], values)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), lists], [key, "factors"])


class Packed:
    """Ratings (user_id, item_id, rating) as cells for both sides, stored until ``remove``."""

    def __init__(self, ratings: DataFrame, rows: int, hot: tuple[list, list], k: int, tasks: int):
        self.spark, self.k = ratings.sparkSession, k
        self.kinds = {f: ratings.schema[f].dataType.simpleString() for f in ("user_id", "item_id")}
        self.folder = f"{shared_folder(self.spark)}/{self.spark.sparkContext.applicationId}/cells-{uuid.uuid4().hex}"
        ids = {key: cut_lineage(ratings.select(key).distinct()) for key in ("user_id", "item_id")}
        g, h = (groups(rows, ids[key].count(), k, tasks) for key in ("user_id", "item_id"))
        self.users = Side("user_id", g, sorted(hot[0]), 0, h + 1)
        self.items = Side("item_id", h, sorted(hot[1]), self.users.slots, g + 1)
        self.ids = {side.key: self._placed_ids(ids[side.key], side) for side in (self.users, self.items)}
        self.sizes = {key: {r["group"]: r["count"] for r in df.groupBy("group").count().collect()} for key, df in self.ids.items()}
        self.packed_ids = {key: cut_lineage(df.mapInArrow(partial(_pack_ids, key=key, names=[]), PACKED)) for key, df in self.ids.items()}
        self._write(ratings)
        stored = self.spark.read.schema("block int, data binary, slot int").parquet(f"{self.folder}/cells")
        self.stored = stored.select("slot", "block", "data")
        self.cells = {r["slot"]: r["count"] for r in stored.groupBy("slot").count().collect()}

    def _placed_ids(self, ids: DataFrame, side: Side) -> DataFrame:
        placed = _dealt(ids.withColumn("group", side.group()), "group", side.groups + 1)
        return cut_lineage(placed.sortWithinPartitions(side.key))

    def start(self, factors: DataFrame, names: list[str]) -> DataFrame:
        """Start factors of the users, given for their ``ids`` in order, as blocks."""
        return cut_lineage(factors.withColumn("group", self.users.group()).mapInArrow(partial(_pack_ids, key="user_id", names=names), PACKED))

    def rows(self, side: Side, factors: DataFrame) -> DataFrame:
        """Blocks of factors as rows (id, factors)."""
        form = f"`{side.key}` {self.kinds[side.key]}, factors array<double>"
        with settings(self.spark, ROW_BY_ROW):
            return cut_lineage(_dealt(self.packed_ids[side.key].union(factors), "block", side.groups + 1).mapInArrow(partial(_unpacked, key=side.key), form))

    def _write(self, ratings: DataFrame) -> None:
        users, items = self.users, self.items
        rows = ratings.where(F.col("user_id").isNotNull() | F.col("item_id").isNotNull())
        rows = rows.select(items.group().alias("g"), users.group().alias("h"), "item_id", "user_id", "rating")
        rows.mapInArrow(partial(_dealt_ratings, side=users, other=items), PACKED).write.options(**FEW_ROWS).parquet(f"{self.folder}/rows")

        def of_groups(rows: DataFrame, side: Side) -> DataFrame:
            ids = self.packed_ids[side.key].where(F.col("block") < side.groups).select(F.col("block").alias("slot"), F.lit(IDS).alias("block"), "data")
            return _dealt(rows.union(ids), "slot", side.groups).sortWithinPartitions("slot", "block")

        with settings(self.spark, ROW_BY_ROW):
            rows = self.spark.read.schema(PACKED).parquet(f"{self.folder}/rows")
            rows = of_groups(rows, users).mapInArrow(partial(_dealt_again, side=users, other=items), PACKED)
            parts = of_groups(rows, items).mapInArrow(partial(_cut, side=items, other=users), PACKED)
            by_slot = _dealt(parts, "slot", users.slots + items.slots).sortWithinPartitions("slot", "block")
            by_slot.mapInArrow(_merged, PACKED).write.options(**FEW_ROWS).partitionBy("slot").parquet(f"{self.folder}/cells")
        self._delete("rows")

    def half_round(self, side: Side, factors: DataFrame, regularisation: float) -> DataFrame:
        """Factors of ``side`` from those of the other side, both as blocks."""
        k, sizes = self.k, self.sizes[side.key]
        to = {"regularisation": regularisation, "strict": self.spark.conf.get("spark.sql.ansi.enabled") == "true"}

        def task(slot: int, met: DataFrame, function, **about) -> DataFrame:
            # The group's cells come first, see ``_added``.
            both = self.stored.where(F.col("slot") == slot).coalesce(1).union(met.coalesce(1)).coalesce(1)
            return both.mapInArrow(partial(function, cells=self.cells[slot], k=k, **about), PACKED)

        # A group without ratings that count has no task and no block: its ids get no factors.
        with settings(self.spark, ROW_BY_ROW):
            found = [
                task(side.first + g, factors, _solved_group, size=sizes[g], group=g, **to)
                for g in range(side.groups) if side.first + g in self.cells
            ]
            hot = {b: int(side.slot(side.groups, b)) for b in range(side.blocks)}
            parts = [
                task(slot, factors.where(F.col("block") == b), _part_of_sums, size=sizes[side.groups], block=b)
                for b, slot in hot.items() if slot in self.cells
            ]
            if parts:
                solve = partial(_solved_parts, size=sizes[side.groups], k=k, group=side.groups, **to)
                found.append(reduce(DataFrame.union, parts).repartition(1).mapInArrow(solve, PACKED))
            return cut_lineage(reduce(DataFrame.union, found)) if found else self.spark.createDataFrame([], PACKED)

    def _delete(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def remove(self) -> None:
        self._delete()
