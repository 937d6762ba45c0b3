"""Quality rules with line labelling by a linear-chain conditional random field.

Two verdicts meet.  The base rules count words, symbols, repeated lines and repeated
five-word windows of the whole text.  The chain labels every line as content or
boilerplate (Viterbi decoding over line features); a document is kept if enough of its
words stand in content lines.

Nobody labels lines, so the states of the training lines are hidden.  What is seen of a
line is noisy: the label of its document, which a line contradicts with the odds
`LABEL_ODDS`, and hints of boilerplate (bars, symbols, shouting, a line or a word said
again) with the odds `HINT_ODDS`.  Gradient ascent maximises the probability of what is
seen, summed over all paths of hidden states: each step is the difference between the
expectations with and without it.  So a good page may hold a navigation bar and a bad
one a sentence, and the steps between states are learned from such pages.  Training uses at
most `TRAIN_DOCS` labelled documents; scoring is one pass over all whole texts without a
shuffle.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts

#: Documents of the training sample, and lines that one training step pads and holds at once.
TRAIN_DOCS, TRAIN_STEP = 3000, 200_000
CONTENT_SHARE = 0.5
#: Odds that a line is of the kind that its document's label, or a hint, says.
LABEL_ODDS, HINT_ODDS = 3.0, 12.0

_BYTE = np.arange(256)
_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_SYMBOL = np.isin(_BYTE, list(b"#*$%&|<>"))
_LEAD = (_BYTE & 0xC0) != 0x80  # first byte of a code point
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | (_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 0xC0)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_MARK = np.isin(_BYTE, list(b"!?"))
_END = np.isin(_BYTE, list(b".!?:;,"))

#: Of a line, in the order of `lines_of`.
FEATURES = ("one", "log_words", "word_length", "symbols", "capitals", "marks", "digits", "ends", "repeated_line", "same_word", "short", "bars")


def dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A small number for each pair of numbers, equal for equal pairs only."""
    if not len(a):
        return np.zeros(0, np.int64)
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, size: int = 5) -> np.ndarray:
    """Words of each document inside windows of `size` words that stand in it twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return np.zeros(n_docs, np.int64)
    inside = doc[:n] == doc[size - 1 :]
    window = doc[:n].astype(np.int64)
    for j in range(size):
        window = dense(window, ids[j : j + n])
    window = np.where(inside, window, -1)
    again = inside & (np.bincount(window + 1)[window + 1] > 1)
    change = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return np.bincount(doc[np.cumsum(change[:-1]) > 0], minlength=n_docs)


@dataclass
class Lines:
    """Counts of each document, and features of each line."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    first: np.ndarray  # of each document's lines
    line_words: np.ndarray
    features: np.ndarray


def lines_of(texts: list[bytes]) -> Lines:
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    line_end = np.flatnonzero(raw == 10)
    line_begin = np.concatenate([[0], line_end[:-1] + 1])
    first = np.searchsorted(line_begin, begin)
    doc_of_line = np.repeat(np.arange(len(texts)), np.diff([*first, len(line_begin)]))

    def by_line(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[line_end] - total[line_begin]

    def by_doc(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, first) if len(x) else np.zeros(len(texts), np.int64)

    space = _SPACE[raw]
    starts = ~space
    starts[1:] &= space[:-1]
    line_words = by_line(starts)
    chars = by_line(~space & _LEAD[raw])
    n_symbols = by_line(_SYMBOL[raw])
    words = joined.split()
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    del words, number
    n_words = by_doc(line_words)
    doc_of_word = np.repeat(np.arange(len(texts)), n_words)
    line_of_word = np.repeat(np.arange(len(line_begin)), line_words)
    same = np.zeros(len(ids), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    same_words = np.bincount(line_of_word[same], minlength=len(line_begin))
    again = np.zeros(len(line_begin), bool)
    b, e, w, d = line_begin.tolist(), line_end.tolist(), line_words.tolist(), doc_of_line.tolist()
    seen: set[bytes] = set()
    now = -1
    for i in range(len(b)):
        if d[i] != now:
            seen, now = set(), d[i]
        if w[i]:
            line = joined[b[i] : e[i]]
            if line in seen:
                again[i] = True
            else:
                seen.add(line)
    length = np.maximum(chars, 1)
    last = np.where(line_end > line_begin, raw[np.maximum(line_end - 1, 0)], 32)
    features = np.stack([
        np.ones(len(b)),
        np.log1p(line_words) / 4,
        chars / np.maximum(line_words, 1) / 8,
        np.minimum(n_symbols / length * 4, 2),
        by_line(_UPPER[raw]) / np.maximum(by_line(_LETTER[raw]), 1) * 2,
        np.minimum(by_line(_MARK[raw]) / np.maximum(line_words, 1), 2),
        by_line(_DIGIT[raw]) / length * 2,
        _END[last],
        again,
        same_words / np.maximum(line_words, 1) * 2,
        line_words < 4,
        np.minimum(by_line(raw == 124) / np.maximum(line_words, 1) * 2, 2),
    ], axis=1)
    return Lines(n_words, by_doc(chars), by_doc(n_symbols), by_doc(again.astype(np.int64)), repeated_words(ids, doc_of_word, len(texts)), first, line_words, features)


@dataclass
class Chain:
    """States: 0 boilerplate, 1 content.  weights: features by state; step: state by next state."""

    weights: np.ndarray
    step: np.ndarray
    start: np.ndarray

    def viterbi(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best state of each line; first: where each document's lines begin."""
        score = features @ self.weights
        score[first] += self.start
        s0, s1 = score[:, 0].tolist(), score[:, 1].tolist()
        (t00, t01), (t10, t11) = self.step.tolist()
        begins = np.zeros(len(s0), bool)
        begins[first] = True
        begins = begins.tolist()
        back0, back1 = [0] * len(s0), [0] * len(s0)
        a = c = 0.0
        best = [0] * len(s0)
        for i in range(len(s0)):
            if begins[i]:
                best[i - 1] = int(c >= a)
                a, c = s0[i], s1[i]
                continue
            x0, x1, y0, y1 = a + t00, c + t10, a + t01, c + t11
            back0[i], back1[i] = int(x1 > x0), int(y1 >= y0)
            a, c = max(x0, x1) + s0[i], max(y0, y1) + s1[i]
        best[-1] = int(c >= a)
        for i in range(len(s0) - 1, 0, -1):
            if not begins[i]:
                best[i - 1] = back1[i] if best[i] else back0[i]
        return np.array(best, bool)


def hinted(features: np.ndarray) -> np.ndarray:
    """Lines with a hint of boilerplate: bars, symbols, shouting, a line or a word said again."""
    f = dict(zip(FEATURES, features.T, strict=True))
    return (f["repeated_line"] > 0) | (f["bars"] >= 0.4) | (f["symbols"] >= 0.4) | (f["capitals"] >= 1.6) & (f["marks"] >= 0.5) | (f["same_word"] >= 1)


def seen(label: int, features: np.ndarray) -> np.ndarray:
    """Log odds, for content, of what is seen of each line of a document."""
    return (1.0 if label else -1.0) * np.log(LABEL_ODDS) - np.log(HINT_ODDS) * hinted(features)


def fit_chain(docs: list[tuple[int, np.ndarray]], rounds: int = 120, rate: float = 0.1, l2: tuple[float, float, float] = (1e-3, 3e-2, 3e-2)) -> Chain:
    """Maximise the log-likelihood of what is seen; docs: (label of the document, features of its lines).

    Both labels weigh the same together, and each document as much as any of its label.
    l2, of the weights, steps and starts, is larger for steps, so that lines speak before
    their neighbours do.
    Without documents of both labels there is nothing to tell apart: every line is content.
    """
    docs = [(y, x) for y, x in docs if len(x)]
    n_f = len(FEATURES)
    if len({y for y, _ in docs}) < 2:
        return Chain(np.zeros((n_f, 2)), np.zeros((2, 2)), np.array([-1.0, 1.0]))
    docs.sort(key=lambda d: len(d[1]))  # stable
    y = np.array([y for y, _ in docs])
    weight = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    weight = weight / np.array([len(x) for _, x in docs])
    batches = [Padded([x for _, x in docs[b:e]], [seen(y, x) for y, x in docs[b:e]], weight[b:e]) for b, e in similar([len(x) for _, x in docs])]
    theta = [np.zeros((n_f, 2)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for k in range(1, rounds + 1):
        grads = [sum(g) for g in zip(*(gradient(theta, b) for b in batches), strict=True)]
        for i, g in enumerate(grads):
            g = g / len(docs) - l2[i] * theta[i]
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            theta[i] = theta[i] + rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(v[i] / (1 - 0.99**k)) + 1e-8)
    return Chain(*theta)


def similar(sizes: list[int], step: int = TRAIN_STEP) -> list[tuple[int, int]]:
    """Ranges of ascending sizes, padded to less than about twice and at most `step` together, one size at least."""
    found, b = [], 0
    for e in range(1, len(sizes) + 1):
        if e == len(sizes) or sizes[e] > 2 * sizes[b] + 8 or sizes[e] * (e + 1 - b) > step:
            found.append((b, e))
            b = e
    return found


class Padded:
    """Documents of ascending length side by side: line, document."""

    def __init__(self, xs: list[np.ndarray], seen: list[np.ndarray], weight: np.ndarray):
        size = np.array([len(x) for x in xs])
        self.n, self.longest, self.weight = len(xs), int(size.max()), weight
        at = np.concatenate([np.arange(k) for k in size]), np.repeat(np.arange(self.n), size)
        self.features = np.zeros((self.longest, self.n, xs[0].shape[1]))
        self.features[at] = np.concatenate(xs)
        self.seen = np.zeros((self.longest, self.n))
        self.seen[at] = np.concatenate(seen)
        self.mask = np.zeros((self.longest, self.n))
        self.mask[at] = 1
        #: The first document that has line t.
        self.first = np.searchsorted(size, np.arange(self.longest), "right").tolist()


def marginals(emit: np.ndarray, step: np.ndarray, start: np.ndarray, first: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each line's state and of each pair of neighbours' states (line, document, ...)."""
    E, S = np.exp(emit - emit.max(-1, keepdims=True)), np.exp(step - step.max())
    alpha, beta = np.ones_like(E), np.ones_like(E)
    alpha[0] = E[0] * np.exp(start - start.max())
    alpha[0] /= alpha[0].sum(-1, keepdims=True)
    for t in range(1, len(E)):
        k = first[t]
        a = (alpha[t - 1, k:] @ S) * E[t, k:]
        alpha[t, k:] = a / a.sum(-1, keepdims=True)
    for t in range(len(E) - 2, -1, -1):
        k = first[t + 1]
        b = (E[t + 1, k:] * beta[t + 1, k:]) @ S.T
        beta[t, k:] = b / b.sum(-1, keepdims=True)
    one = alpha * beta
    two = alpha[:-1, :, :, None] * S * (E * beta)[1:, :, None, :]
    return one / one.sum(-1, keepdims=True), two / two.sum((-2, -1), keepdims=True)


def gradient(theta: list[np.ndarray], docs: Padded) -> list[np.ndarray]:
    """Gradient of the weighted log-likelihood of what is seen: expectations given it, less those of the chain alone."""
    W, S, B = theta
    free = docs.features @ W
    given = free.copy()
    given[..., 1] += docs.seen
    both = np.stack([given, free], 2).reshape(docs.longest, 2 * docs.n, 2)
    one, two = marginals(both, S, B, [2 * k for k in docs.first])
    weight = docs.mask * docs.weight
    diff = np.einsum("tnks,tn,k->tns", one.reshape(docs.longest, docs.n, 2, 2), weight, [1, -1])
    pair = np.einsum("tnkij,tn,k->ij", two.reshape(-1, docs.n, 2, 2, 2), weight[1:], [1, -1])
    return [np.einsum("tnf,tns->fs", docs.features, diff), pair, diff[0].sum(0)]


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_docs: int = TRAIN_DOCS) -> Chain:
    """Fit the chain on a bounded sample of labelled documents, chosen by a hash of their ids.

    All lines of the chosen documents are used.  Only their features, 12 numbers a line,
    leave the executors, one partition at a time; the driver keeps them in a file.  The
    sample is broadcast to the documents; its size is max_docs rows.  Rows of labels
    without an id or a label are left out; of several for one id the larger label counts.
    Labels of one kind only, or none, teach nothing: then every line is content and the
    base rules decide alone.
    """
    sample = (
        labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
        .groupBy(F.col(f"`{doc_id}`").alias("sample_id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("sample_label"))
        .orderBy(F.xxhash64("sample_id"), "sample_id").limit(max_docs)
    )
    rows = docs.select(docs[f"`{doc_id}`"].alias("sample_id"), docs[f"`{text}`"].alias("t")).join(F.broadcast(sample), "sample_id")
    fields = [T.StructField("lines", T.ArrayType(T.FloatType()))]

    def features(texts: list[bytes]) -> list:
        x = lines_of(texts)
        ends = [*x.first[1:].tolist(), len(x.line_words)]
        return [[x.features[b:e].ravel().astype(np.float32) for b, e in zip(x.first.tolist(), ends, strict=True)]]

    got = map_texts(rows, "t", fields, features, ["sample_id", "sample_label"]).orderBy("sample_id")
    sizes, truth = [], []
    with tempfile.TemporaryFile() as file:
        for row in got.toLocalIterator():
            np.array(row.lines, np.float32).tofile(file)
            sizes.append(len(row.lines) // len(FEATURES))
            truth.append(int(row.sample_label))
        file.flush()
        flat = np.memmap(file, np.float32, "r").reshape(-1, len(FEATURES)) if sum(sizes) else np.zeros((0, len(FEATURES)))
        ends = np.cumsum(sizes).tolist()
        return fit_chain([(y, flat[e - n : e]) for y, n, e in zip(truth, sizes, ends, strict=True)])


FIELDS = [
    *[T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("content_share", T.DoubleType()),
]


def judge(docs: DataFrame, chain: Chain, *, keep: list[str], text: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """Columns `keep` of every document, then its counts and verdicts.

    Null and empty texts have no words, so the base rules reject them (fewer than 10
    words).  content_share is the share of words in content lines, 0 without words.
    Repeated rows are judged alike, each for itself.
    """

    def score(texts: list[bytes]) -> list:
        x = lines_of(texts)
        content = np.where(chain.viterbi(x.features, x.first), x.line_words, 0)
        share = np.add.reduceat(content, x.first) / np.maximum(x.n_words, 1)
        failed = (x.n_words < 10) | (100 * x.n_repeat_words > 20 * x.n_words)
        return [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, failed, ~failed & (share >= content_share), share]

    return map_texts(docs, text, FIELDS, score, keep)


def filter_documents(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", train_on: DataFrame | None = None, **options) -> DataFrame:
    """The documents that pass, with their own columns only."""
    chain = train(docs if train_on is None else train_on, labels, doc_id=doc_id, text=text)
    work = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), docs[f"`{text}`"].alias("t"))
    return judge(work, chain, keep=["doc"], text="t", **options).where("kept").select("doc.*")
