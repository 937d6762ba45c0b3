"""Substring dedup with automata of repeated phrases.

A window is 50 consecutive words; it goes if the same words also start in a document
with a smaller id.  The job has four steps, each a Spark job over whole texts:

1. Winnowing picks an anchor in every window: the eight-word phrase with the smallest
   hash, leftmost of equals.  Equal windows have the same anchor at the same place, so
   a window can only recur if its anchor phrase does.  Consecutive windows with one
   anchor are a segment.  Two aggregations (partial at the source) confirm the phrases
   that stand in two documents or more, and the segments that do, with their smallest id.
2. The phrases are compiled into Aho-Corasick automata, sharded by hash to about
   `SHARD_PHRASES` each; the segments become sorted look-up tables, sharded too.  Both
   are files in the shared folder.
3. All documents stream through every automaton, which locates each occurrence of a
   phrase.  An occurrence is extended to the windows that it anchors; their segment is
   looked up, and goes whole if its words belong to a smaller id.  A task loads an
   automaton once for about `BLOCK_BYTES` of text.
4. Check of single windows, where one anchor has different segments (the edges of
   a passage, near copies): only a segment's first owner brings in its windows, as
   128-bit keys, which are grouped and joined back.

Words are 64-bit hashes of all their bytes, computed for many texts at once.  The automata
hold words as letters of a 64-letter alphabet, because the library searches a node's
edges one after another; a false match has a segment that no table has.  Segments are told
apart by a 64-bit sum of their words' hashes beside the 48 bits of their phrase, single
windows by two such sums: of two different ones with the same phrase one pair in 2 ** 64
would be taken for equal.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, new_folder, saved, steps
from .files import get, make_folder, put

WINDOW, PHRASE = 50, 8
#: About so many phrases make an automaton, of at most 500 bytes of memory each.
SHARD_PHRASES = 100_000
#: About so many segments make a look-up table, of 24 bytes each.
SHARD_SEGMENTS = 1_000_000
#: Text bytes that are read into words together, and that meet an automaton together.
READ_BYTES, BLOCK_BYTES = 2 << 20, 48 << 20
#: Rows after which a task hands on what it has.
FLUSH_ROWS = 2000

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FACTOR, _OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Ends a document in a string of letters.
_END = ord("\n")


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    return _powers(base, 1 << max(18, (n - 1).bit_length()))[:n]


def smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each `span` consecutive values, by doubling."""
    n, width = len(values) - span + 1, 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[:n], values[span - width : span - width + n])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, one text after the other, and how many each text has."""
    joined = b"\n".join(texts) + b"\n" + bytes(8)
    raw = np.frombuffer(joined, np.uint8)
    space = _SPACE[raw[:-8]]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    begin, end = edge[::2], edge[1::2]
    size = end - begin
    eight = np.ndarray(len(raw) - 7, "<u8", joined, strides=(1,))
    h = mixed_bits(size.astype(np.uint64) * np.uint64(_FACTOR))
    at, left = np.arange(len(begin)), size
    while len(at):
        chunk = eight[begin[at] + (size[at] - left)]
        short = left < 8
        chunk[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        h[at] = mixed_bits((h[at] ^ chunk) * np.uint64(_FACTOR))
        more = left > 8
        at, left = at[more], left[more] - 8
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.searchsorted(begin, np.cumsum(length + 1) - length - 1)
    return h, np.diff(first, append=len(begin))


class Words:
    """Words of many texts side by side, each text with an end behind it, and their windows."""

    def __init__(self, texts: list[bytes], window: int = WINDOW, phrase: int = PHRASE):
        h, self.counts = word_hashes(texts)
        self.window, self.phrase = window, phrase
        n = len(h) + len(texts)
        stop = np.cumsum(self.counts + 1) - 1
        #: Of each text: where its words begin.
        self.begin = stop - self.counts
        is_word = np.ones(n, bool)
        is_word[stop] = False
        self.hash = np.zeros(n, np.uint64)
        self.hash[is_word] = h
        self.letters = np.full(n, _END, np.uint8)
        self.letters[is_word] = (h & np.uint64(63)).astype(np.uint8) + np.uint8(48)
        left = np.repeat(stop, self.counts + 1) - np.arange(n)
        starts = np.flatnonzero(left >= window)
        if not len(starts):
            self.first = self.last = self.anchor = np.zeros(0, np.int64)
            return
        order = np.zeros(n - phrase + 1, np.uint64)
        for j in range(phrase):
            order = order * np.uint64(_FACTOR) + self.hash[j : n - phrase + 1 + j]
        # The hash above, the place below: the leftmost of equals is the least.
        order = (mixed_bits(order) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(order), dtype=np.uint64)
        anchor = (smallest(order, window - phrase + 1)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(anchor, prepend=-1))
        #: Of each segment: its first window, the window behind its last, its anchor; ascending.
        self.first, self.last, self.anchor = starts[new], starts[np.append(new[1:], len(starts)) - 1] + 1, anchor[new]

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, at, "right") - 1

    def sums(self, first: np.ndarray, stop: np.ndarray, factor: int = _FACTOR) -> np.ndarray:
        """64 bits of the words [first, stop), wherever they stand."""
        n = len(self.hash)
        own = self.hash if factor == _FACTOR else mixed_bits(self.hash + np.uint64(factor))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(own * powers(factor, n), out=total[1:])
        return (total[stop] - total[first]) * powers(pow(factor, -1, 1 << 64), n)[first]

    def keys(self) -> np.ndarray:
        """Of each segment: its words, and its anchor's place in them."""
        place = (self.anchor - self.first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return (self.sums(self.first, self.last + self.window - 1) + place).view(np.int64)

    def phrases(self) -> np.ndarray:
        """The letters of each segment's anchor, packed into a long."""
        out = np.zeros((len(self.anchor), 8), np.uint8)
        out[:, : self.phrase] = self.letters[self.anchor[:, None] + np.arange(self.phrase)]
        return out.view("<i8").ravel()

    def windows(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """For each range of windows, 128 bits of the words of each of them."""
        n = last - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        both = np.stack([self.sums(at, at + self.window, f) for f in (_FACTOR, _OTHER)], axis=1).astype("<u8").tobytes()
        ends = (16 * np.cumsum(n)).tolist()
        return [both[b:e] for b, e in zip([0, *ends], ends, strict=False)]


def find_segments(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Distinct segments (phrase, key) with the smallest and the largest id that has them."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, 1, READ_BYTES):
                x = Words(as_bytes(step.column(1)), window, phrase)
                columns = [step.column(0).take(pa.array(x.text_of(x.first))), pa.array(x.phrases()), pa.array(x.keys())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "phrase", "key"])

    found = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(anchors, "doc_id long, phrase long, key long")
    return saved(found.groupBy("phrase", "key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")), "segments")


def stored_shards(rows: DataFrame, key: str, most: int, name: str, make) -> list[str]:
    """make(table) -> bytes for each shard of rows, put into the shared folder by the tasks; the files' names."""
    shards = max(1, -(-rows.count() // most))
    folder = new_folder(rows.sparkSession, name)
    make_folder(folder)

    def build(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        put(f"{folder}/{shard:06d}", make(table))
        return pa.table({"shard": pa.array([shard], pa.int64())})

    keyed = rows.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)))
    done = saved(keyed.groupBy("shard").applyInArrow(build, "shard long"), f"{name}-list")
    return [f"{folder}/{r.shard:06d}" for r in done.orderBy("shard").toLocalIterator()]


def compile_automata(segments: DataFrame, size: int = PHRASE, shard_phrases: int = SHARD_PHRASES) -> list[str]:
    """Automata of the phrases of two documents or more; a phrase's value is 1 if it has several segments."""
    phrases = segments.groupBy("phrase").agg(F.min("owner").alias("a"), F.max("last").alias("b"), F.count("*").alias("n"))
    phrases = saved(phrases.where("a < b").select("phrase", (F.col("n") > 1).alias("mixed")), "phrases")

    def make(table: pa.Table) -> bytes:
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for phrase, mixed in zip(table.column("phrase").to_numpy().tolist(), table.column("mixed").to_pylist(), strict=True):
            automaton.add_word(phrase.to_bytes(8, "little", signed=True)[:size].decode("ascii"), int(mixed))
        automaton.make_automaton()
        return pickle.dumps(automaton, protocol=5)

    return stored_shards(phrases, "phrase", shard_phrases, "automata", make)


def store_owners(segments: DataFrame, shard_segments: int = SHARD_SEGMENTS) -> list[str]:
    """Look-up tables of the segments of two documents or more: key, phrase and smallest id, by key."""

    def make(table: pa.Table) -> bytes:
        rows = np.stack([table.column(c).to_numpy() for c in ("key", "phrase", "owner")])
        return np.ascontiguousarray(rows[:, np.lexsort((rows[1], rows[0]))], "<i8").tobytes()

    return stored_shards(segments.where("owner < last"), "key", shard_segments, "owners", make)


def owners_of(rows: np.ndarray, keys: np.ndarray, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a table has each segment, and the smallest id of it."""
    at = np.searchsorted(rows[0], keys)
    found, owner = np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    todo = np.arange(len(keys))
    while len(todo):  # segments of one key and different phrases stand side by side
        todo = todo[at[todo] < rows.shape[1]]
        todo = todo[rows[0, at[todo]] == keys[todo]]
        hit = rows[1, at[todo]] == phrases[todo]
        found[todo[hit]], owner[todo[hit]] = True, rows[2, at[todo[hit]]]
        todo = todo[~hit]
        at[todo] += 1
    return found, owner


def occurrences(letters: str, automaton) -> tuple[np.ndarray, np.ndarray]:
    """Where the automaton's phrases end in the letters, and their values."""
    found = np.fromiter((x for hit in automaton.iter(letters) for x in hit), np.int64)
    return found[::2], found[1::2]


class Part:
    """Texts that were read together, and what the automata report in them."""

    def __init__(self, ids: list[int], rows: list[int], texts: list[bytes], window: int, phrase: int):
        self.ids, self.rows, self.words = np.array(ids, np.int64), np.array(rows, np.int64), Words(texts, window, phrase)
        self.letters = self.words.letters.tobytes().decode("ascii")  # an end keeps matches inside a text
        self.ends: list[np.ndarray] = []
        self.values: list[np.ndarray] = []

    def scan(self, automaton) -> None:
        for got, kept in zip(occurrences(self.letters, automaton), (self.ends, self.values), strict=True):
            kept.append(got)

    def extend(self) -> None:
        """The segments that the reported occurrences anchor, as places in the segments' list."""
        w = self.words
        places = np.concatenate(self.ends) - w.phrase + 1
        at = np.searchsorted(w.anchor, places)
        anchors = at < len(w.anchor)
        anchors[anchors] = w.anchor[at[anchors]] == places[anchors]
        self.segments, self.mixed = at[anchors], np.concatenate(self.values)[anchors] > 0
        order = np.argsort(self.segments)
        self.segments, self.mixed = self.segments[order], self.mixed[order]
        self.keys, self.phrases = w.keys()[self.segments], w.phrases()[self.segments]
        self.text = w.text_of(w.first[self.segments])
        self.known, self.owner = np.zeros(len(self.segments), bool), np.zeros(len(self.segments), np.int64)

    def look_up(self, table: np.ndarray) -> None:
        found, owner = owners_of(table, self.keys, self.phrases)
        self.known |= found
        self.owner[found] = owner[found]

    def spans(self) -> Iterator[pa.RecordBatch]:
        """(doc_id, row, first, last, windows); see `locate`."""
        w = self.words
        later = self.known & (self.owner < self.ids[self.text])
        s, text = self.segments[later], self.text[later]
        first, stop = w.first[s], w.last[s] + w.window - 1
        new = np.ones(len(s), bool)  # a span that the one before does not reach
        new[1:] = (first[1:] > stop[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        yield from self._batches(text[begin], first[begin], stop[np.append(begin[1:] - 1, len(s) - 1)[: len(begin)]], None)
        open_ = self.mixed & ~later
        s, text = self.segments[open_], self.text[open_]
        for i in range(0, len(s), FLUSH_ROWS):
            own = s[i : i + FLUSH_ROWS]
            yield from self._batches(text[i : i + FLUSH_ROWS], w.first[own], w.last[own] + w.window - 1, w.windows(w.first[own], w.last[own]))

    def _batches(self, text: np.ndarray, first: np.ndarray, stop: np.ndarray, windows: list[bytes] | None) -> Iterator[pa.RecordBatch]:
        offset = self.words.begin[text]
        columns = [self.ids[text], self.rows[text], first - offset, stop - offset, windows if windows is not None else [None] * len(text)]
        if len(text):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=["doc_id", "row", "first", "last", "windows"])


_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())


def locate(docs: DataFrame, automata: list[str], tables: list[str], window: int, phrase: int) -> DataFrame:
    """(doc_id, row, first, last, windows) of all documents: spans of words that belong to a smaller
    id (windows is null), and segments of first owners with the 128-bit keys of their windows."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[Part] = []
        size = 0
        for batch in batches:
            for step in steps(batch, 2, READ_BYTES):
                texts = as_bytes(step.column(2))
                block.append(Part(step.column(0).to_pylist(), step.column(1).to_pylist(), texts, window, phrase))
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES:
                    yield from found_in(block)
                    block, size = [], 0
        yield from found_in(block)

    def found_in(block: list[Part]) -> Iterator[pa.RecordBatch]:
        block = [p for p in block if len(p.words.anchor)]
        if not block or not automata:
            return
        for path in automata:  # one in memory at a time, and none in an idle worker
            automaton = pickle.loads(get(path))
            for part in block:
                part.scan(automaton)
            del automaton
        for part in block:
            part.extend()
        for path in tables:
            table = np.frombuffer(get(path), "<i8").reshape(3, -1)
            for part in block:
                part.look_up(table)
            del table
        for part in block:
            yield from part.spans()

    rows = docs.where("doc_id is not null").select("doc_id", "row", "text")
    return saved(rows.mapInArrow(stream, "doc_id long, row long, first long, last long, windows binary"), "located")


def repeated_spans(located: DataFrame, window: int) -> DataFrame:
    """(doc_id, row, spans): word ranges that also start in a document with a smaller id."""
    whole = located.where("windows is null").select("doc_id", "row", "first", "last")
    keys = F.expr("transform(sequence(0, length(windows) div 16 - 1), i -> substring(windows, i * 16 + 1, 16))")
    single = located.where("windows is not null").select("doc_id", "row", "first", F.posexplode(keys).alias("i", "w")).select("doc_id", "row", (F.col("first") + F.col("i")).alias("first"), "w")
    earliest = single.groupBy("w").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other")).where("owner < other").select("w", "owner")
    alone = single.join(earliest, "w").where("doc_id > owner").select("doc_id", "row", "first", (F.col("first") + window).alias("last"))
    return whole.unionByName(alone).groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, phrase: int = PHRASE, shard_phrases: int = SHARD_PHRASES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every document.

    kept is what stays of the text, its words joined by single blanks.  Words are runs of
    anything but ASCII white space.  Null and empty texts have no words.  A row without
    an id loses nothing and takes nothing from others; repeated ids are one document,
    so copies under one id stay.  Windows are judged on the input.
    """
    if not 1 <= phrase <= min(8, window):
        raise ValueError("a phrase has at most 8 words and fits into a window")
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), F.xxhash64(docs[f"`{text}`"]).alias("row"), docs[f"`{text}`"].alias("text"))
    segments = find_segments(rows, window, phrase)
    spans = repeated_spans(locate(rows, compile_automata(segments, phrase, shard_phrases), store_owners(segments), window, phrase), window)
    joined = rows.join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, 1):
                out: list[tuple] = []
                for t, spans in zip(as_bytes(step.column(1)), step.column(2), strict=True):
                    words = kept = t.split()
                    if spans.is_valid:
                        change = np.zeros(len(words) + 1, np.int64)
                        ends = spans.values
                        np.add.at(change, ends.field(0).to_numpy(), 1)
                        np.add.at(change, ends.field(1).to_numpy(), -1)
                        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                    rest = b" ".join(kept)
                    out.append((len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode()))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([step.column(0), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
