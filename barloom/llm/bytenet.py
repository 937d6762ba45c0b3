"""Quality by a convolutional network over bytes, in numpy.

Each byte is a symbol, and another one where it ends a repeat of what stood shortly before.
A text's symbols are cut into chunks that overlap by half and cover all of it.  Learned
filters over embedded symbols slide through each chunk and the largest answer of a filter in a
chunk is kept; over the chunks of a document the largest and the mean answers stand for the
document, and a logistic layer makes one probability of them.

Training takes a bounded sample of labelled rows and runs in a task, so that a lost
executor repeats it; only the weights, some thousand numbers, reach the driver.  Scoring
takes every document where it is, in steps of bounded memory.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, map_texts, saved

#: Labelled rows that training uses at most, and bytes of their texts.
TRAIN_ROWS, TRAIN_BYTES = 2_000, 4_000_000
#: A chunk is two blocks of so many bytes, and the next begins a block later.
BLOCK = 256
#: Numbers for a byte; bytes under a filter; bytes between its places; filters.
EMBEDDED, WIDTH, STRIDE, FILTERS = 8, 8, 2, 24
#: A byte that ends a repeat is a symbol of its own: it and the bytes before it, REPEAT in all, stood so up to NEAR bytes before.
REPEAT, NEAR = 4, 24
#: The symbol around a text, beside the bytes and the bytes that end a repeat.
PAD, SYMBOLS = 512, 513
#: Blocks whose answers are computed at once.
STEP_BLOCKS = 256
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.01, 11
THRESHOLD = 0.3


@dataclass
class Net:
    """Embedding of the symbols, filters with their biases, and the logistic layer."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    base: np.ndarray

    @classmethod
    def new(cls, seed: int = SEED) -> Net:
        r = np.random.default_rng(seed)
        normal = lambda *shape, scale: r.normal(0, scale, shape).astype(np.float32)
        return cls(normal(SYMBOLS, EMBEDDED, scale=0.5), normal(WIDTH * EMBEDDED, FILTERS, scale=(WIDTH * EMBEDDED) ** -0.5), np.zeros(FILTERS, np.float32), normal(2 * FILTERS, scale=0.1), np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights, self.base]

    def probability(self, texts: list[bytes]) -> np.ndarray:
        """One probability for each text, from 0 to 1; a text without bytes is all padding."""
        if not texts:
            return np.zeros(0)
        chunks, first, _ = answers(self, Blocks(texts))
        z = document(chunks, first) @ self.weights + self.base
        return 1 / (1 + np.exp(-z.astype(np.float64)))


def symbols(text: bytes) -> np.ndarray:
    """The symbol of each byte."""
    x = np.frombuffer(text, np.uint8)
    found = np.zeros(len(x), bool)
    for lag in range(2, NEAR + 1):
        n = len(x) - lag - REPEAT + 1
        if n <= 0:
            break
        same = x[lag:] == x[:-lag]
        run = same[:n].copy()
        for k in range(1, REPEAT):
            run &= same[k : k + n]
        found[lag + REPEAT - 1 :] |= run
    return x + np.int16(256) * found


class Blocks:
    """The symbols of some texts; block k of a document is symbols k * BLOCK to (k + 1) * BLOCK and those that a filter reaches behind."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.count = np.maximum(1, -(-sizes // BLOCK))
        self.first = np.cumsum(self.count) - self.count
        room = self.count * BLOCK + WIDTH - 1
        begin = np.cumsum(room) - room
        self.symbols = np.full(int(room.sum()), PAD, np.int16)
        for t, b in zip(texts, begin.tolist(), strict=True):
            self.symbols[b : b + len(t)] = symbols(t)
        inside = np.arange(int(self.count.sum())) - np.repeat(self.first, self.count)
        self.start = np.repeat(begin, self.count) + inside * BLOCK
        #: Of a document's last block the chunk has no second one, but for documents of one.
        self.last = inside + 1 == np.repeat(self.count, self.count)


def windows(net: Net, x: Blocks, at: slice) -> np.ndarray:
    """The embedded symbols under each place of a filter, of some blocks."""
    embedded = net.embedding[x.symbols[x.start[at, None] + np.arange(BLOCK + WIDTH - 1)]]
    seen = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)[:, ::STRIDE]
    return seen.transpose(0, 1, 3, 2).reshape(len(embedded), -1, WIDTH * EMBEDDED)


def answers(net: Net, x: Blocks, where: bool = False) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """The filters' largest answers in each chunk, a document's first chunk, and (block, place) of each answer if asked."""
    n = len(x.start)
    top, place = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64) if where else None
    for b in range(0, n, STEP_BLOCKS):
        at = slice(b, b + STEP_BLOCKS)
        got = windows(net, x, at) @ net.filters
        if where:
            place[at] = np.ascontiguousarray(got.transpose(0, 2, 1)).argmax(axis=2)
            top[at] = np.take_along_axis(got, place[at][:, None], axis=1)[:, 0]
        else:
            top[at] = got.max(axis=1)
    top = np.maximum(top + net.bias, 0)
    # A chunk is a block and the next one; the last block stands alone where it is the only one.
    chunk = ~x.last | np.repeat(x.count == 1, x.count)
    at = np.flatnonzero(chunk)
    after = np.where(x.last[at], at, at + 1)
    count = np.maximum(1, x.count - 1)
    first = np.cumsum(count) - count
    second = top[after] > top[at]
    chunks = np.where(second, top[after], top[at])
    if not where:
        return chunks, first, None
    block = np.where(second, after[:, None], at[:, None])
    return chunks, first, (block, place[block, np.arange(FILTERS)])


def document(chunks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest and mean answers over each document's chunks."""
    count = np.diff(np.append(first, len(chunks)))[:, None]
    return np.concatenate([np.maximum.reduceat(chunks, first), np.add.reduceat(chunks, first) / count], axis=1)


def gradients(net: Net, texts: list[bytes], truth: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The weighted log loss of some texts and its gradients, in the order of `parameters`."""
    x = Blocks(texts)
    chunks, first, (block, place) = answers(net, x, where=True)
    doc = document(chunks, first)
    p = 1 / (1 + np.exp(-(doc @ net.weights + net.base).astype(np.float64)))
    loss = -float((weight * np.log(np.where(truth > 0, p, 1 - p) + 1e-12)).sum() / weight.sum())
    dz = (weight * (p - truth) / weight.sum()).astype(np.float32)
    d_doc = dz[:, None] * net.weights
    count = np.diff(np.append(first, len(chunks)))
    owner = np.repeat(np.arange(len(texts)), count)
    d = (d_doc[:, FILTERS:] / count[:, None])[owner]
    # The largest answer of a document takes the gradient in its first chunk that has it.
    is_top = chunks == doc[owner, :FILTERS]
    seen = np.cumsum(is_top, axis=0)
    before = seen[first] - is_top[first]
    d += np.where(is_top & (seen - before[owner] == 1), d_doc[owner, :FILTERS], 0)
    d *= chunks > 0
    f = np.broadcast_to(np.arange(FILTERS), d.shape)
    hit = d != 0
    d, f, start = d[hit], f[hit], x.start[block[hit]] + STRIDE * place[hit]
    below = x.symbols[start[:, None] + np.arange(WIDTH)]
    under = net.embedding[below].reshape(len(d), WIDTH * EMBEDDED)
    d_filters = np.stack([d[f == k] @ under[f == k] for k in range(FILTERS)], axis=1)
    back = (d[:, None] * net.filters.T[f]).reshape(-1, EMBEDDED)
    d_embedding = np.stack([np.bincount(below.ravel(), back[:, k], SYMBOLS) for k in range(EMBEDDED)], axis=1).astype(np.float32)
    return loss, [d_embedding, d_filters, np.bincount(f, d, FILTERS).astype(np.float32), doc.T @ dz, dz.sum(keepdims=True)]


def fit(texts: list[bytes], truth: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Net:
    """A net by Adam over shuffled batches; both labels weigh the same in all."""
    net, r = Net.new(seed), np.random.default_rng(seed)
    y = np.array(truth, np.float64)
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    n_steps, t = epochs * -(-len(texts) // BATCH), 0
    for _ in range(epochs):
        order = r.permutation(len(texts))
        for b in range(0, len(texts), BATCH):
            some, t = order[b : b + BATCH], t + 1
            _, grads = gradients(net, [texts[i] for i in some], y[some], weight[some])
            rate = RATE * (1 - (t - 1) / n_steps)
            for p, g, m, v in zip(net.parameters(), grads, mean, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
    return net


@dataclass
class Model:
    net: Net | None

    def score(self, docs: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
        """Columns `keep` of every document, and score, the probability of label 1.

        Null and empty texts are all padding and have the score of that.  Without a net
        (labels of one kind only, or none) every score is 0.5.  Repeated rows are scored
        row by row.
        """
        net = self.net

        def run(texts: list[bytes]) -> list:
            return [np.full(len(texts), 0.5) if net is None else net.probability(texts)]

        return map_texts(docs, text, [T.StructField("score", T.DoubleType())], run, keep)


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", usable: Column | None = None, max_rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> Model:
    """Learn from at most max_rows labelled rows and max_bytes of their whole texts, chosen by a hash of their ids.

    Rows of labels without an id or a label are left out, and those for which `usable` is
    false; of several labels for one id the larger counts.  The chosen ids are broadcast:
    max_rows of them at most.  A text that would exceed max_bytes is left out of the sample.
    """
    chosen = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
    if usable is not None:
        chosen = chosen.where(usable)
    chosen = chosen.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
    chosen = chosen.withColumn("h", F.xxhash64("id", F.lit(12))).orderBy("h", "id").limit(max_rows)
    rows = docs.select(docs[f"`{doc_id}`"].alias("id"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    rows = saved(rows.select("h", "id", "label", "text"), "labelled")
    # Sizes of the sample, some thousand rows.
    sizes = rows.select("h", "id", "label", F.octet_length("text").alias("size"), F.xxhash64("text").alias("t")).dropDuplicates(["id", "t"])
    so_far = Window.partitionBy(F.lit(0)).orderBy("h", "id", "t").rowsBetween(Window.unboundedPreceding, 0)
    kept = sizes.where(F.col("size") <= max_bytes).withColumn("sum", F.sum("size").over(so_far)).where(F.col("sum") <= max_bytes)
    sample = rows.withColumn("t", F.xxhash64("text")).dropDuplicates(["id", "t"]).join(F.broadcast(kept.select("id", "t")), ["id", "t"]).select("h", "id", "t", "label", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(*(batch.column(i).to_pylist() for i in range(3)), as_bytes(batch.column(4)), batch.column(3).to_pylist(), strict=True)
        found.sort()
        net = fit([x[3] for x in found], [x[4] for x in found]) if len({x[4] for x in found}) == 2 else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)])], names=["net"])

    net = saved(sample.coalesce(1).mapInArrow(learn, "net binary"), "net").first()
    return Model(pickle.loads(net.net) if net else None)
