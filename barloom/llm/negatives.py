"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors are sorted by label and nearest pivot and cut into blocks of bounded size; a task
links each block by its shortest spanning tree and puts it into the shared folder.  For two
anchors a and b and any row c, `|a.c - b.c| <= |a - b| * |c|`: a row's score at a parent, plus or
minus the edge's length times the row's norm, bounds its score at the child.  So the rows of
a slice are scored exactly at the tree's root; at every other anchor only those are scored
whose bounds overlap what is wanted there, the rest hand their bounds down.

Wanted are first the best rows of the anchor's own label (its positives), bounds against
the last of those found so far; then, for each positive, the best rows of other labels
within its window of scores, bounds against the window's ends and the last found.  Rows stay
where they are read; what leaves a slice is a few rows for each anchor, and a window, which
Spark limits before its shuffle, takes the best of them.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_folder, saved
from .files import get, make_folder, put

#: Anchors of a block at most; pivots that order them; bytes of vectors that a slice holds; rows scored at once.
BLOCK_ANCHORS, PIVOTS, SLICE_BYTES, STEP_ROWS = 1024, 64, 32 << 20, 4096
#: Scores beyond 64 bits count as the nearest in it, components beyond this as this.
LOWEST, HIGHEST, LARGEST = -(1 << 63), (1 << 63) - 1, 1e150
#: What rounding may add to a bound.
SLACK = 1e-9


def matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of each component; shorter vectors are filled with zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(scale * vectors.flatten().to_numpy()), -LARGEST, LARGEST)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def widths(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns as the wider."""
    n = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == n else np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in (a, b))


def products(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers with x."""
    if np.abs(rows).max(initial=0) * np.abs(x).max(initial=0) * max(1, len(x)) < 2.0**53:
        return (rows @ x).astype(np.int64)
    whole = [int(v) for v in x.tolist()]
    return np.array([min(max(sum(int(a) * b for a, b in zip(r, whole, strict=True)), LOWEST), HIGHEST) for r in rows.tolist()], np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length): rows from the root on, each after its parent (-1 for the root), and the edges' lengths."""
    n = len(x)
    near, parent, order = np.full(n, np.inf), np.full(n, -1), np.empty(n, np.int64)
    left, now = np.ones(n, bool), 0
    for i in range(n):
        order[i], left[now] = now, False
        d = np.linalg.norm(x - x[now], axis=1)
        closer = left & (d < near)
        near[closer], parent[closer] = d[closer], now
        near[now] = np.inf
        now = int(np.argmin(np.where(left, near, np.inf)))
    length = np.where(parent < 0, 0.0, np.linalg.norm(x - x[parent], axis=1))
    return order, parent, length


class Anchors:
    """A block of anchors and its tree."""

    def __init__(self, ids: list, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order, self.parent, self.length = spanning_tree(x)
        self.children = np.bincount(self.parent[self.parent >= 0], minlength=len(ids))
        self.own = [int(products(x[i : i + 1], x[i])[0]) for i in range(len(ids))]


def scored(anchors: Anchors, rows: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores) of all rows that `wanted(anchor, low, high)` picks by the bounds of their scores.

    wanted is asked in the tree's order and gives a mask; the scores are exact.
    """
    x, rows = widths(anchors.x, rows)
    norms = np.linalg.norm(rows, axis=1)
    held: dict[int, list] = {}
    for a in anchors.order.tolist():
        p = int(anchors.parent[a])
        if p < 0:
            middle, radius = products(rows, x[a]), np.zeros(len(rows))
            pick = np.flatnonzero(wanted(a, middle, middle))
        else:
            middle, radius = held[p][0], held[p][1] + anchors.length[a] * norms * (1 + SLACK)
            held[p][2] -= 1
            if not held[p][2]:
                del held[p]
            reach = radius + SLACK * (1 + np.abs(middle))
            pick = np.flatnonzero(wanted(a, middle - reach, middle + reach))
            if 2 * len(pick) > len(rows):
                middle, radius = products(rows, x[a]), np.zeros(len(rows))
            elif len(pick):
                middle = middle.copy()
                middle[pick], radius[pick] = products(rows[pick], x[a]), 0.0
        if anchors.children[a]:
            held[a] = [middle, radius, int(anchors.children[a])]
        if len(pick):
            yield a, pick, middle[pick]


class Best:
    """The best rows of a key, by descending score and ascending id, rows without an id last."""

    def __init__(self, top: int):
        self.top, self.found = top, []

    @property
    def least(self) -> int:
        return -self.found[-1][0] if len(self.found) == self.top else LOWEST

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good) > self.top:
            good = good[scores[good] >= np.partition(scores[good], -self.top)[-self.top]]
        if len(good):
            new = [(-s, i is None, i if i is not None else 0) for s, i in zip(scores[good].tolist(), ids[good].tolist(), strict=True)]
            self.found = heapq.nsmallest(self.top, [*self.found, *new])


@lru_cache(maxsize=1)
def stored(path: str):
    return pickle.loads(get(path))


@lru_cache(maxsize=1)
def stored_windows(path: str) -> dict[int, list[tuple]]:
    """For each anchor its positives (rank, id, score); none where the file was not written."""
    return pickle.loads(get(path))


def slices(batches: Iterator[pa.RecordBatch], scale: float, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of rows that together hold about `limit` bytes."""
    held, size = [], 0

    def out() -> tuple:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, labels, vectors = (table.column(i).combine_chunks() for i in range(3))
        keep = np.empty(table.num_rows, object)
        keep[:] = ids.to_pylist()
        return keep, labels.to_numpy(), matrix(vectors, scale)

    for batch in batches:
        wide = max(1, -(-8 * len(batch.column(2).flatten()) // max(1, batch.num_rows)))
        for at in range(0, batch.num_rows, step := max(1, limit // wide)):
            held.append(batch.slice(at, step))
            size += held[-1].num_rows * wide
            if size >= limit:
                yield out()
                held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield out()


def store_anchors(rows: DataFrame, scale: float, block_anchors: int) -> tuple[str, list[str]]:
    """The folder of the anchors' blocks, and the blocks' names."""
    spark = rows.sparkSession
    folder = new_folder(spark, "anchors")
    make_folder(folder)
    chosen = rows.where("anchor").select("id", "label", "vector")
    # A bounded sample, by a hash of the ids, that only orders the anchors.
    sample = chosen.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("vector").collect()
    pivots = matrix(pa.array([r.vector for r in sample], pa.list_(pa.float64())), scale)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, p = widths(matrix(batch.column(2), scale), pivots)
            nearest = np.array([np.argmin(np.linalg.norm(p - v, axis=1)) for v in x], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], names=["id", "label", "vector", "pivot"])

    ordered = saved(chosen.mapInArrow(near, T.StructType([*chosen.schema.fields, T.StructField("pivot", T.LongType())])), "anchor-pivots")
    n = ordered.count()
    key = ["label", "pivot", "id", "vector"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, left = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            left = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            while left.num_rows > block_anchors:
                yield store(left.slice(0, block_anchors), f"{part:06d}-{number:06d}")
                left, number = left.slice(block_anchors), number + 1
        if left is not None and left.num_rows:
            yield store(left, f"{part:06d}-{number:06d}")

    def store(table: pa.Table, name: str) -> pa.RecordBatch:
        columns = [table.column(i).combine_chunks() for i in range(3)]
        put(f"{folder}/{name}", pickle.dumps(Anchors(columns[0].to_pylist(), columns[1].to_numpy(), matrix(columns[2], scale))))
        return pa.RecordBatch.from_arrays([pa.array([name])], names=["block"])

    dealt = ordered.repartitionByRange(max(1, -(-n // block_anchors)), *key).sortWithinPartitions(*key).select("id", "label", "vector")
    names = saved(dealt.mapInArrow(build, "block string"), "anchor-blocks")
    return folder, sorted(r.block for r in names.toLocalIterator())


def mine(vectors: DataFrame, *, anchor: Column, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0, block_anchors: int = BLOCK_ANCHORS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Rows with a null label or vector or any null or infinite component or NaN take no part.
    Components become floor(scale * x), scores are integer inner products; equal scores go
    by ascending id, rows without an id last.  An anchor's positives are its best other rows
    of the same label; the negatives of one are the best rows of another label with
    `low * positive_score <= 100 * score <= high * positive_score`.

    Repeated rows are rows of their own: a copy of an anchor is its positive, and a
    repeated anchor gives its rows again.  Shorter vectors count as filled with zeros.  Scores
    beyond 64 bits count as the nearest number in it.  Empty tables give no rows.
    """
    value = F.col(f"`{label}`") if isinstance(label, str) else label
    v = F.col(f"`{vector}`").cast("array<double>")
    whole = v.isNotNull() & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = vectors.where(value.isNotNull() & whole).select(F.col(f"`{vec_id}`").alias("id"), value.cast("long").alias("label"), v.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    folder, blocks = store_anchors(rows, scale, block_anchors)
    rows, kind = rows.select("id", "label", "vector"), rows.schema["id"].dataType
    place = [T.StructField("block", T.StringType()), T.StructField("place", T.IntegerType())]

    def best_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, x in slices(batches, scale, slice_bytes):
            for block in blocks:
                anchors: Anchors = stored(f"{folder}/{block}")
                best = [Best(positives + 1) for _ in anchors.ids]  # the anchor itself is among them
                for at in range(0, len(ids), STEP_ROWS):
                    some, own = ids[at : at + STEP_ROWS], labels[at : at + STEP_ROWS]

                    def wanted(a: int, _low: np.ndarray, high: np.ndarray, own=own, best=best, anchors=anchors) -> np.ndarray:
                        return (own == anchors.labels[a]) & (high >= best[a].least)

                    for a, pick, scores in scored(anchors, x[at : at + STEP_ROWS], wanted):
                        best[a].add(some[pick], scores)
                yield _batch([(block, a, i, s, anchors.ids[a] == i and anchors.own[a] == s) for a, b in enumerate(best) for s, i in _unpacked(b)], [pa.string(), pa.int32(), _arrow(kind), pa.int64(), pa.bool_()], ["block", "place", "id", "score", "own"])

    schema = T.StructType([*place, T.StructField("id", kind), T.StructField("score", T.LongType()), T.StructField("own", T.BooleanType())])
    near = saved(rows.mapInArrow(best_positives, schema), "slice-positives")
    first = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), F.desc("own"))
    near = near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= positives + 1)
    # One row that is the anchor's own goes; without one the last is too many.
    near = near.withColumn("owns", F.sum(F.col("own").cast("int")).over(first.rowsBetween(Window.unboundedPreceding, 0))).where(~(F.col("own") & (F.col("owns") == 1)))
    near = near.withColumn("k", F.col("k") - F.least("owns", F.lit(1))).where(F.col("k") <= positives)

    def keep_windows(table: pa.Table) -> pa.Table:
        block, found = table.column("block")[0].as_py(), {}
        for a, k, i, s in sorted(zip(*(table.column(c).to_pylist() for c in ("place", "k", "id", "score")), strict=True), key=lambda r: r[:2]):
            found.setdefault(a, []).append((k, i, s))
        put(f"{folder}/windows-{block}", pickle.dumps(found))
        return pa.table({"block": pa.array([block])})

    # A group is a block: its anchors times their positives.
    done = {r.block for r in saved(near.select("block", "place", "k", "id", "score").groupBy("block").applyInArrow(keep_windows, "block string"), "window-blocks").toLocalIterator()}
    names = ["block", "place", "k", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def best_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, x in slices(batches, scale, slice_bytes):
            for block in blocks:
                if block not in done:
                    continue
                anchors, windows = stored(f"{folder}/{block}"), stored_windows(f"{folder}/windows-{block}")
                # Scores from ceil(low * p / 100) to floor(high * p / 100) are in the window of a positive score p.
                spans = {a: [(-(-low * s // 100), high * s // 100, Best(negatives), k, i, s) for k, i, s in w] for a, w in windows.items()}
                for at in range(0, len(ids), STEP_ROWS):
                    some, own = ids[at : at + STEP_ROWS], labels[at : at + STEP_ROWS]

                    def wanted(a: int, least: np.ndarray, most: np.ndarray, own=own, spans=spans, anchors=anchors) -> np.ndarray:
                        found = np.zeros(len(own), bool)
                        for begin, end, best, *_ in spans.get(a, ()):
                            found |= (most >= max(begin, best.least)) & (least <= end)
                        return found & (own != anchors.labels[a])

                    for a, pick, scores in scored(anchors, x[at : at + STEP_ROWS], wanted):
                        for begin, end, best, *_ in spans[a]:
                            inside = (scores >= begin) & (scores <= end)
                            best.add(some[pick[inside]], scores[inside])
                found = [(block, a, k, anchors.ids[a], i, s, j, t) for a, w in spans.items() for _, _, best, k, i, s in w for t, j in _unpacked(best)]
                yield _batch(found, [pa.string(), pa.int32(), pa.int32(), _arrow(kind), _arrow(kind), pa.int64(), _arrow(kind), pa.int64()], names)

    fields = [*place, T.StructField("k", T.IntegerType()), *[T.StructField(c, kind if c.endswith("_id") else T.LongType()) for c in names[3:]]]
    far = saved(rows.mapInArrow(best_negatives, T.StructType(fields)), "slice-negatives")
    best_first = Window.partitionBy("block", "place", "k").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    ranked = far.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _unpacked(best: Best) -> list[tuple[int, object]]:
    return [(-s, None if none else i) for s, none, i in best.found]


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
