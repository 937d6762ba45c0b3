"""Ranked lexical search by presence masks.

Items (queries) are dealt by hash into blocks of bounded size, which tasks prepare and put
into the shared folder.  One pass over the documents counts, for each, its words and how
often the terms of a block occur; only these postings are stored.  Document frequencies
come from them, and tasks put the terms' weights beside the blocks.

The search reads the postings in shards.  In a shard each term has a bitmap of the
documents that hold it.  The bitmaps of an item's terms, laid side by side, give every
document its presence mask; documents are grouped by mask, a mask's largest possible
score is the sum of its terms' largest contributions in the shard, and masks are
evaluated from the largest such score down until it falls below the last score wanted.
What a shard finds is at most `top` rows for each item; the best of all shards follow by a
window, which Spark limits before its shuffle.
"""

from __future__ import annotations

import heapq
import pickle
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, new_folder, saved, steps
from .decontaminate import words
from .files import get, make_folder, put

#: Text bytes of items that a block holds.
BLOCK_BYTES = 4_000_000
#: Documents and postings of a shard at most; one document is a shard at least.
SHARD_DOCS, SHARD_POSTINGS = 16_384, 2_000_000
#: Documents that are scored at once, to begin with.
FIRST_STEP = 64


class Items:
    """A block of items: the number of each term, and each item's distinct terms."""

    def __init__(self, texts: list[bytes | None]):
        self.number: dict[bytes, int] = {}
        self.terms = [np.array(sorted({self.number.setdefault(w, len(self.number)) for w in words(t or b"")}), np.int64) for t in texts]


class Shard:
    """Postings of some documents: row, term and how often, with what each adds to a score."""

    def __init__(self, n_docs: int, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, weight: np.ndarray):
        added = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        self.n, self.weight = n_docs, weight
        self.begin = np.searchsorted(row, np.arange(n_docs + 1))
        self.term, self.added = term, added
        by_term = np.argsort(term, kind="stable")
        self.row_of, self.sorted_terms = row[by_term], term[by_term]
        self.present, first = np.unique(self.sorted_terms, return_index=True)
        self.first = np.append(first, len(term))
        self.most = np.maximum.reduceat(added[by_term], first) if len(term) else np.zeros(0, np.int64)
        self._bits: dict[int, np.ndarray] = {}

    def bitmap(self, k: int) -> np.ndarray:
        """Documents of the k-th present term, one bit each."""
        if k not in self._bits:
            there = np.zeros(self.n, np.uint8)
            there[self.row_of[self.first[k] : self.first[k + 1]]] = 1
            self._bits[k] = np.packbits(there)
        return self._bits[k]

    def masks(self, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matched documents, the number of each one's mask, and the masks (terms by masks)."""
        maps = np.stack([self.bitmap(k) for k in ks.tolist()])
        docs = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps), count=self.n))
        bits = np.unpackbits(maps, axis=1, count=self.n)[:, docs]
        group = np.zeros(len(docs), np.int64)
        for i in range(0, len(ks), 64):
            packed = np.packbits(bits[i : i + 64], axis=0)
            word = np.zeros((len(docs), 8), np.uint8)
            word[:, : len(packed)] = packed.T
            _, own = np.unique(word.view(np.uint64)[:, 0], return_inverse=True)
            _, first, group = np.unique(group * (int(own.max()) + 1) + own, return_index=True, return_inverse=True)
        return docs, group, bits[:, first]

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of documents; wanted: for each term, whether the item has it."""
        size = self.begin[docs + 1] - self.begin[docs]
        owner = np.repeat(np.arange(len(docs)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + self.begin[docs][owner]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, owner, np.where(wanted[self.term[at]], self.added[at], 0))
        return out

    def search(self, terms: np.ndarray, best: list[tuple], ids: pa.Array, top: int) -> tuple[list[tuple], int]:
        """The best (-score, id is null, id) of `best` and this shard, and how many documents were scored."""
        k = np.searchsorted(self.present, terms)
        k = k[(k < len(self.present)) & (self.present[np.minimum(k, len(self.present) - 1)] == terms)] if len(self.present) else k[:0]
        if not len(k):
            return best, 0
        docs, group, bits = self.masks(k)
        bound = self.most[k] @ bits.astype(np.int64)
        order = np.argsort(-bound[group], kind="stable")
        docs, bound = docs[order], bound[group][order]
        wanted = np.zeros(len(self.weight), bool)
        wanted[terms] = True
        at, step = 0, FIRST_STEP
        while at < len(docs):
            least = -best[-1][0] if len(best) == top else 1
            end = min(at + step, int(np.searchsorted(-bound, -least, side="right")))
            if end <= at:
                break
            some = docs[at:end]
            got = self.scores(some, wanted)
            good = np.flatnonzero(got >= least)
            if len(good) > top:
                good = good[got[good] >= np.partition(got[good], -top)[-top]]
            found = [(-s, i is None, i if i is not None else 0) for s, i in zip(got[good].tolist(), ids.take(pa.array(some[good])).to_pylist(), strict=True)]
            best = heapq.nsmallest(top, [*best, *found])
            at, step = end, 4 * step
        return best, at


def shard_ends(sizes: np.ndarray, docs: int = SHARD_DOCS, postings: int = SHARD_POSTINGS) -> list[int]:
    """Where shards end, of documents with so many postings each."""
    ends, n, size = [], 0, 0
    for i, s in enumerate(sizes.tolist()):
        if n and (n == docs or size + s > postings):
            ends.append(i)
            n = size = 0
        n, size = n + 1, size + s
    return [*ends, len(sizes)] if len(sizes) else []


def store_items(items: DataFrame, item: str, text: str, block_bytes: int) -> tuple[DataFrame, str, int]:
    """(block, place, item) of every item with a text, the folder of the blocks, and their number."""
    folder = new_folder(items.sparkSession, "items")
    make_folder(folder)
    rows = items.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{item}`").alias("item"), F.encode(F.col(f"`{text}`"), "UTF-8").alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    kind = rows.schema["item"]

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("item", "ascending"), ("t", "ascending")])
        block = table.column("block")[0].as_py()
        put(f"{folder}/items-{block:06d}", pickle.dumps(Items(table.column("t").to_pylist())))
        place = pa.array(range(table.num_rows), pa.int32())
        return pa.table({"block": table.column("block"), "place": place, "item": table.column("item")})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(n)).cast("int"))
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("place", T.IntegerType()), kind])
    return saved(dealt.groupBy("block").applyInArrow(build, schema), "item-places"), folder, n


@lru_cache(maxsize=1)
def stored(path: str):
    return pickle.loads(get(path))


def postings(docs: DataFrame, doc_id: str, text: str, folder: str, blocks: list[int]) -> DataFrame:
    """(doc_id, block, n, terms, times) of every document with words: all its words, and the block's terms in it.

    The first block has a row for each document, others only for those that hold a term.
    """
    inputs = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("t"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([inputs.schema["doc_id"], T.StructField("block", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("times", ints)])
    lists = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 1):
                counted = [Counter(words(t)) for t in as_bytes(part.column(1))]
                sizes = [c.total() for c in counted]
                for b in blocks:
                    number = stored(f"{folder}/items-{b:06d}").number
                    keep, terms, times = [], [], []
                    for i, c in enumerate(counted):
                        held = sorted((number[w], w) for w in c.keys() & number.keys())
                        if held or sizes[i] and b == blocks[0]:
                            keep.append(i)
                            terms.append([k for k, _ in held])
                            times.append([c[w] for _, w in held])
                    columns = [part.column(0).take(pa.array(keep, pa.int64())), pa.array([b] * len(keep), pa.int32()), pa.array([sizes[i] for i in keep], pa.int64()), pa.array(terms, lists), pa.array(times, lists)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "block", "n", "terms", "times"])

    found = inputs.mapInArrow(run, schema)
    return found.sortWithinPartitions("block") if len(blocks) > 1 else found


def store_weights(found: DataFrame, folder: str, n_docs: int) -> None:
    """For each block a file of its terms' weights; a term of no document has none to give."""
    held = found.select("block", F.explode("terms").alias("term")).groupBy("block", "term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1)))
    weighed = held.select("block", "term", weight.cast("long").alias("w"))

    def build(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        term = table.column("term").to_numpy()
        weights = np.zeros(len(stored(f"{folder}/items-{block:06d}").number), np.int64)
        weights[term] = table.column("w").to_numpy()
        put(f"{folder}/weights-{block:06d}", pickle.dumps(weights))
        return pa.table({"block": pa.array([block], pa.int32())})

    saved(weighed.groupBy("block").applyInArrow(build, "block int"), "weight-blocks")


def search(docs: DataFrame, items: DataFrame, *, top: int = 10, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, doc_id, score): each item's `top` documents with a score above 0, ties by ascending doc_id.

    Terms are runs of letters (A-Z lower-cased), digits and characters beyond ASCII.  The
    score of a document is the sum, over an item's distinct terms, of
    `w * (10**9 * tf div (1000 * tf + 8 * m))`, with `w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`
    and `m = 10 + 90 * n * N div L` in 64-bit integers: N documents with words, L words in all,
    n of the document.

    Null and empty texts have no terms: such documents do not count, such items find
    nothing.  Repeated rows, of items or documents, are rows of their own; of documents with
    equal scores one without an id comes last.  Empty tables give no rows.
    """
    places, folder, _ = store_items(items, item, item_text, block_bytes)
    blocks = sorted(r.block for r in places.select("block").distinct().toLocalIterator())
    found = saved(postings(docs, doc_id, text, folder, blocks), "postings")
    first = found.where(F.col("block") == (blocks[0] if blocks else -1)).agg(F.count("*"), F.sum("n")).first()
    n_docs, n_words = first[0], first[1] or 1
    store_weights(found, folder, n_docs)
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("place", T.IntegerType()), found.schema["doc_id"], T.StructField("score", T.LongType())])

    def flush(block: int, best: dict[int, list[tuple]], kind: pa.DataType) -> pa.RecordBatch:
        rows = [(place, None if none else i, -s) for place, found in best.items() for s, none, i in found]
        place, ids, score = zip(*rows, strict=True) if rows else ((), (), ())
        columns = [pa.array([block] * len(rows), pa.int32()), pa.array(place, pa.int32()), pa.array(ids, kind), pa.array(score, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "place", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, kind = None, {}, pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            edges = batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(edges)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if (block := int(edges[begin])) != now:
                    if now is not None:
                        yield flush(now, best, kind)
                    now, best = block, {}
                wanted, weights = stored(f"{folder}/items-{block:06d}"), stored_weights(f"{folder}/weights-{block:06d}")
                sizes = np.array(part.column(3).value_lengths().to_numpy(zero_copy_only=False))
                at = 0
                for to in shard_ends(sizes):
                    some = part.slice(at, to - at)
                    n, size = some.column(2).to_numpy(), sizes[at:to]
                    shard = Shard(to - at, np.repeat(np.arange(to - at), size), some.column(3).flatten().to_numpy().astype(np.int64), some.column(4).flatten().to_numpy().astype(np.int64), 10 + (90 * n * n_docs) // n_words, weights)
                    for place, terms in enumerate(wanted.terms):
                        got, _ = shard.search(terms, best.get(place, []), some.column(0), top)
                        if got:
                            best[place] = got
                    at = to
        if now is not None:
            yield flush(now, best, kind)

    each = saved(found.where(F.size("terms") > 0).mapInArrow(run, schema), "shard-best")
    best_first = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = each.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    joined = ranked.join(places, ["block", "place"])
    return joined.select(F.col("item").alias(item), "rank", F.col("doc_id").alias(doc_id), "score")


@lru_cache(maxsize=1)
def stored_weights(path: str) -> np.ndarray:
    return pickle.loads(get(path))
