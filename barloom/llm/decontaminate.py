"""Benchmark decontamination with suffix arrays over the training text.

Every task takes its documents in shards of a few MB, turns them into integer word
ids, sorts the word suffixes that can match (a suffix array), and binary-searches
every test suffix in it: the suffixes that begin with the wanted number of words form
one range of the array, the longest verbatim match stands beside the place where the
whole test suffix would be inserted.  Documents are never shuffled.  The benchmark
is dealt by hash into blocks of about `BLOCK_BYTES` bytes, which tasks prepare and put
into the shared folder; a task holds one block at a time and takes its documents through
all of them.

Pruning that loses nothing: words outside the benchmark's vocabulary share one id that
no test suffix holds, so a suffix whose run of known words is shorter than the shortest
window is left out of the array before it is sorted.
"""

from __future__ import annotations

import hashlib
import pickle
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, map_texts, new_folder, saved
from .files import get, make_folder, put

WINDOW = 13
#: Text bytes of benchmark items that a task holds at once.
BLOCK_BYTES = 12_000_000

#: A-Z become a-z; every byte that is not part of a word becomes a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


class TestSet:
    """A block of benchmark items, in any order: word ids, suffixes and windows."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        number: dict[str, int] = {}
        tokens: list[int] = []
        self.starts, self.lengths, self.left, self.owner = [], [], [], []
        for item, text in sorted(items, key=lambda x: (x[0] is not None, x[0] or "", x[1])):
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            size = min(window, len(own))
            k = number.setdefault(item, len(number))
            for i in range(len(own) - size + 1) if own else ():
                self.starts.append(len(tokens) + i)
                self.lengths.append(size)
                self.left.append(len(own) - i)
                self.owner.append(k)
            tokens += [*own, -1]
        self.names = list(number)
        self.starts, self.lengths, self.left, self.owner = (np.array(x, np.int64) for x in (self.starts, self.lengths, self.left, self.owner))
        self.depth = int(self.left.max(initial=1))
        self.least = int(self.lengths.min(initial=1))
        self.tokens = np.array(tokens + [-1] * (self.depth + 1), np.int64)
        self.bits = max(2, (len(self.ids) + 1).bit_length())


def suffix_array(tokens: np.ndarray, at: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Positions `at` in the order of the first `depth` words that follow.

    tokens must hold `depth` more entries after the last position.  Words are packed
    into 62-bit keys; each round sorts only what all earlier keys left tied.
    """
    per = 62 // bits

    def key(p: np.ndarray, offset: int) -> np.ndarray:
        k = np.zeros(len(p), np.int64)
        for j in range(offset, offset + per):
            k = (k << bits) | (tokens[p + j] if j < depth else 0)
        return k

    k = key(at, 0)
    o = np.argsort(k, kind="stable")
    order, new = at[o], np.ones(len(at), bool)
    new[1:] = k[o][1:] != k[o][:-1]
    for offset in range(per, depth, per):
        tied = ~new
        tied[:-1] |= ~new[1:]
        idx = np.flatnonzero(tied)
        if not len(idx):
            break
        group, sub = np.cumsum(new)[idx], order[idx]
        k = key(sub, offset)
        o = np.lexsort((k, group))
        order[idx], k, group = sub[o], k[o], group[o]
        new[idx[1:]] = (group[1:] != group[:-1]) | (k[1:] != k[:-1])
    return order


def _signs(shard: np.ndarray, p: np.ndarray, test: np.ndarray, q: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of suffixes: -1, 0 or 1 over the first `length` words, and the words in common."""
    sign, common, open_ = np.zeros(len(p), np.int8), np.zeros(len(p), np.int64), np.arange(len(p))
    j = 0
    while len(open_):
        open_ = open_[length[open_] > j]
        a, b = shard[p[open_] + j], test[q[open_] + j]
        differ = a != b
        sign[open_[differ]] = np.where(a < b, -1, 1)[differ]
        open_ = open_[~differ]
        common[open_] += 1
        j += 1
    return sign, common


def search(shard: np.ndarray, sa: np.ndarray, test: np.ndarray, q: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of the suffix array whose suffixes begin with the `length` words at each q."""
    ends = []
    for upper in (False, True):
        low, high = np.zeros(len(q), np.int64), np.full(len(q), len(sa), np.int64)
        while len(todo := np.flatnonzero(low < high)):
            mid = (low[todo] + high[todo]) // 2
            sign, _ = _signs(shard, sa[mid], test, q[todo], length[todo])
            right = sign <= 0 if upper else sign < 0
            low[todo[right]] = mid[right] + 1
            high[todo[~right]] = mid[~right]
        ends.append(low)
    return ends[0], ends[1]


def _expand(sa: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each range's number, and the positions in it."""
    n = high - low
    number = np.repeat(np.arange(len(n)), n)
    return number, sa[np.arange(len(number)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]


def match_shard(found: list[list[bytes]], test: TestSet) -> list[dict]:
    """What a shard of documents, each a list of words, has in common with a block of the benchmark."""
    ids = _Ids(test.ids)
    counts = np.array([len(w) for w in found], np.int64)
    begin = np.cumsum(counts + 1) - counts - 1
    shard = np.zeros(int(counts.sum()) + len(found) + test.depth + 1, np.int64)
    for s, w in zip(begin.tolist(), found, strict=True):
        shard[s : s + len(w)] = np.fromiter(map(ids.__getitem__, w), np.int64, len(w))
    out = [{"n_words": int(n), "spans": [], "items": [], "longest": 0, "longest_start": None, "longest_item": None} for n in counts]
    gaps = np.flatnonzero(shard == 0)
    known = np.flatnonzero(shard)
    run = gaps[np.searchsorted(gaps, known)] - known
    at = known[run >= test.least]
    if not len(at) or not len(test.starts):
        return out
    sa = suffix_array(shard, at, test.depth, test.bits)
    low, high = search(shard, sa, test.tokens, test.starts, test.lengths)
    hit = np.flatnonzero(low < high)
    if not len(hit):
        return out
    # The same window in many items is expanded once.
    _, first, same = np.unique(np.stack([low[hit], high[hit], test.lengths[hit]]), axis=1, return_index=True, return_inverse=True)
    same = same.ravel()
    number, p = _expand(sa, low[hit[first]], high[hit[first]])
    change = np.zeros(len(shard) + 1, np.int64)
    np.add.at(change, p, 1)
    np.add.at(change, p + test.lengths[hit[first]][number], -1)
    covered = np.cumsum(change) > 0
    edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        d = int(np.searchsorted(begin, s, "right")) - 1
        out[d]["spans"].append((s - int(begin[d]), e - int(begin[d])))
    # Documents by window, windows by item, then each pair of document and item once.
    doc = np.searchsorted(begin, p, "right") - 1
    pairs = np.unique(number * len(found) + doc)
    owners = np.unique(same * len(test.names) + test.owner[hit])
    window_of, item_of = owners // len(test.names), owners % len(test.names)
    low_o, high_o = np.searchsorted(window_of, pairs // len(found)), np.searchsorted(window_of, pairs // len(found), "right")
    n, item = _expand(item_of, low_o, high_o)
    for x in np.unique((pairs % len(found))[n] * len(test.names) + item).tolist():
        out[x // len(test.names)]["items"].append(test.names[x % len(test.names)])
    # Longest matches: beside the place of insertion, then all places that have as many words.
    q = test.starts[hit]
    place, _ = search(shard, sa, test.tokens, q, test.left[hit])
    most = np.zeros(len(q), np.int64)
    for beside in (np.maximum(place - 1, 0), np.minimum(place, len(sa) - 1)):
        most = np.maximum(most, _signs(shard, sa[beside], test.tokens, q, test.left[hit])[1])
    number, p = _expand(sa, *search(shard, sa, test.tokens, q, most))
    doc = np.searchsorted(begin, p, "right") - 1
    o = np.lexsort((test.owner[hit][number], p, -most[number], doc))
    doc, p, number = doc[o], p[o], number[o]
    for i in np.flatnonzero(np.diff(doc, prepend=-1)).tolist():
        d = int(doc[i])
        out[d] |= {"longest": int(most[number[i]]), "longest_start": int(p[i] - begin[d]), "longest_item": test.names[int(test.owner[hit][number[i]])]}
    return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    got: list[list[int]] = []
    for s, e in sorted(spans):
        if got and s <= got[-1][1]:
            got[-1][1] = max(got[-1][1], e)
        else:
            got.append([s, e])
    return [(s, e) for s, e in got]


def summary(n_words: int, found: list[dict]) -> tuple:
    spans = merge([x for f in found for x in f["spans"]])
    items = sorted({x for f in found for x in f["items"] if x is not None})
    n_hit = sum(e - s for s, e in spans)
    best = min(found, key=lambda f: (-f["longest"], f["longest_start"] or 0, f["longest_item"] or ""), default={"longest": 0, "longest_start": None, "longest_item": None})
    return n_words, n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n_words, best["longest"], best["longest_start"], best["longest_item"]


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("longest_match", T.LongType()),
    T.StructField("longest_start", T.LongType()),
    T.StructField("longest_item", T.StringType()),
]


def store_blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> list[str]:
    """Files of the benchmark's blocks; rows without a text have no windows.  There is one block at least."""
    spark = benchmark.sparkSession
    folder = new_folder(spark, "benchmark")
    make_folder(folder)
    rows = benchmark.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{item}`").cast("string").alias("i"), F.encode(F.col(f"`{text}`"), "UTF-8").alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))

    def build(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        put(f"{folder}/{block:06d}", pickle.dumps(TestSet(list(zip(table.column("i").to_pylist(), table.column("t").to_pylist(), strict=True)), window)))
        return pa.table({"block": pa.array([block], pa.int64())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    done = saved(dealt.groupBy("block").applyInArrow(build, "block long"), "benchmark-blocks")
    paths = [f"{folder}/{r.block:06d}" for r in done.orderBy("block").toLocalIterator()]
    if not paths:
        paths = [f"{folder}/none"]
        put(paths[0], pickle.dumps(TestSet([], window)))
    return paths


@lru_cache(maxsize=1)
def stored_block(path: str) -> TestSet:
    return pickle.loads(get(path))


def find_overlap(docs: DataFrame, benchmark: DataFrame, *, keep: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns `keep` of every document, then what it shares with the benchmark.

    A window is `window` consecutive words of an item; an item of fewer words (but not
    none) is one window.  n_hit counts the document's words inside any occurrence of a
    window, n_items the items with an occurring window; longest_match, longest_start and
    longest_item tell the longest verbatim match of a test suffix and where it begins.

    Null or empty texts have no words.  Items without text are skipped; those without
    id count for n_hit, but not as items.  Equal ids count as one item; of longest matches
    that begin at one place the smallest item is told.  Repeated documents are judged row
    by row.  An empty benchmark leaves every document uncontaminated.
    """
    blocks = store_blocks(benchmark, item, item_text, window, block_bytes)

    def judge(texts: list[bytes]) -> list:
        split = [words(t) for t in texts]
        found = [match_shard(split, stored_block(b)) for b in blocks]
        rows = [summary(x[0]["n_words"], list(x)) for x in zip(*found, strict=True)]
        return [list(c) for c in zip(*rows, strict=True)] or [[] for _ in FIELDS]

    # With many blocks a task reads each of them for fewer and larger shards.
    return map_texts(docs, text, FIELDS, judge, keep, STEP_BYTES * min(4, len(blocks)))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns only."""
    work = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), docs[f"`{text}`"].alias("t"))
    judged = find_overlap(work, benchmark, keep=["doc"], text="t", **options)
    return judged.where(~F.col("contaminated")).select("doc.*")
