"""Token ids in directly addressable codes.

Documents are range-partitioned by id and sorted, so file order is id order.  Each task
encodes its texts and writes files of about `FILE_TOKENS` tokens.  An id is split into
8-bit chunks: level 0 holds every id's lowest chunk, level k the k-th chunk of those ids
that have one.  A bitmap of each level tells which entries continue; a rank directory
(ones before every 512th bit) turns an entry's place into its place on the next level,
so any token is read with a few look-ups and no block is decoded.

File: magic, then one little-endian header of 64-bit counts, then arrays (see `pack`).
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, saved, steps
from .files import make_folder, put

END_ID = 2
#: Tokens after which a file is closed; a document stands in one file.
FILE_TOKENS = 4_000_000
#: Words whose ids a worker remembers; the memory is emptied when full.
MEMO = 400_000
#: Text bytes whose distinct pieces are looked up together.
LEARN_BYTES = 4 << 20
MAGIC = b"DACIDS01"
_BLOCK = 512

#: A line of plain letters with punctuation behind, or any other line.
_LINE = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!%$&*#?;:]*)|(.*))$", re.MULTILINE)


class Encoder:
    """Encodes whole texts exactly as the tokenizer does, but each distinct piece once.

    For a tokenizer that never joins across white space (word ends are marked), a text's
    ids are those of its pieces between blanks and line feeds.  A piece of plain letters
    with punctuation behind it is two pre-tokens.  Other tokenizers encode whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Byte-level merges see each UTF-8 byte as a printable letter of its own.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        letter = {x: chr(x) for x in shown} | {x: chr(256 + i) for i, x in enumerate(hidden)}
        high = [chr(x) for x in range(0xC0, 0x100) if x not in (0xD7, 0xF7)]
        self.byte_letters = {ord(c): "".join(letter[x] for x in c.encode()) for c in high}
        self.by_piece = self._pieces_suffice(high)

        self.memo: dict[str, bytes] = {}

    def _pieces_suffice(self, high: list[str]) -> bool:
        """Whether this tokenizer gives a text the ids of its pieces, tried on all letters in question."""
        plain = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        words = [f"{a}{b}a{b}" for a in "abcxyz" for b in [*map(chr, range(97, 123)), *(c.lower() for c in high)]]
        got = self._letters(words)
        whole = [i for w in words for i in np.frombuffer(got[w], "<u4").tolist()]
        return plain(" ".join(words)) == whole == plain("\n ".join(words).upper().replace("SS", "ß")) and plain("ab,. c") == plain("ab") + plain(",.") + plain("c")

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, cores: list[str]) -> dict[str, bytes]:
        """The ids of words of lower-case letters, straight from the merges: such a word is one pre-token."""
        tokenize, to_bytes = self.tokenizer.model.tokenize, self.byte_letters
        parts = [[x.id for x in tokenize(w if w.isascii() else w.translate(to_bytes))] for w in cores]
        whole = np.array(list(chain.from_iterable(parts)), "<u4").tobytes()
        ends = (np.cumsum([len(x) for x in parts]) * 4).tolist()
        return {w: whole[a:b] for w, a, b in zip(cores, [0, *ends], ends, strict=False)}

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of the pieces, which have no line feeds."""
        rows = _LINE.findall("\n".join(pieces))
        cores = "\n".join([r[0] for r in rows]).lower().split("\n")
        memo = self.memo
        new = [c for c in dict.fromkeys(cores) if c and c not in memo]
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(dict.fromkeys(filter(None, cores)))
        memo.update(self._letters(new))
        memo[""] = b""
        rest = list({x for _, marks, other in rows for x in (marks, other) if x})
        other = dict(zip(rest, self._each(rest), strict=True))
        other[""] = b""
        return [memo[c] + other[m] + other[o] for c, (_, m, o) in zip(cores, rows, strict=True)]

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, none of them null."""
        if not self.by_piece:
            return [np.frombuffer(x, "<u4") for x in self._each(texts.to_pylist())]
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        coded = split.values.dictionary_encode()
        own, ids = coded.indices.to_numpy(), self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        n = size[own]
        end = np.cumsum(n)
        every = flat[np.arange(end[-1] if len(end) else 0) + np.repeat(start[own] - end + n, n)]
        cuts = end[split.offsets.to_numpy()[1:] - 1].tolist()  # every text has a piece, if only an empty one
        return [every[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text]))[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- the format -------------------------------------------------------------


def _directory(bits: np.ndarray) -> np.ndarray:
    """Ones before each block of 512 bits."""
    blocks = np.add.reduceat(bits, np.arange(0, len(bits), _BLOCK), dtype=np.int64) if len(bits) else np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")


def pack(doc_ids: list[int | None], ids: list[np.ndarray], part: int, number: int) -> bytes:
    """One file: header (part, number, documents, tokens, levels), document directory, levels."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    known = np.array([d is not None for d in doc_ids], bool)
    levels = []
    while True:
        more = flat > 0xFF
        levels.append(b"".join([struct.pack("<q", len(flat)), (flat & 0xFF).astype(np.uint8).tobytes(), np.packbits(more, bitorder="little").tobytes(), _directory(more).tobytes()]))
        if not more.any():
            break
        flat = flat[more] >> 8
    head = struct.pack("<5q", part, number, len(ids), int(ends[-1]) if len(ends) else 0, len(levels))
    docs = known.astype(np.uint8).tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + ends.astype("<i8").tobytes()
    return b"".join([MAGIC, head, docs, *levels])


class TokenFile:
    """Random access to the ids of a file."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        self.part, self.number, n, self.n_tokens, levels = struct.unpack_from("<5q", data, 8)
        at = 48
        known = np.frombuffer(data, np.uint8, n, at)
        docs = np.frombuffer(data, "<i8", n, at + n)
        self.doc_ids = [d if k else None for d, k in zip(docs.tolist(), known.tolist(), strict=True)]
        self.ends = np.frombuffer(data, "<i8", n, at + 9 * n)
        at += 17 * n
        self.levels = []
        for _ in range(levels):
            (size,) = struct.unpack_from("<q", data, at)
            bits, ranks = -(-size // 8), -(-size // _BLOCK) + 1
            self.levels.append((np.frombuffer(data, np.uint8, size, at + 8), np.frombuffer(data, np.uint8, bits, at + 8 + size), np.frombuffer(data, "<u4", ranks, at + 8 + size + bits)))
            at += 8 + size + bits + 4 * ranks
        if at != len(data):
            raise ValueError("token file has a wrong length")

    def _rank(self, level: int, i: int) -> int:
        _, bits, ranks = self.levels[level]
        block = i // _BLOCK
        inside = np.unpackbits(bits[block * _BLOCK // 8 : -(-i // 8)], bitorder="little")[: i - block * _BLOCK]
        return int(ranks[block]) + int(inside.sum())

    def token(self, i: int) -> int:
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """ids [start, end): each level is entered by its rank directory."""
        out = np.zeros(end - start, np.uint32)
        at = np.arange(end - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * level)
            more = np.unpackbits(bits[start >> 3 : -(-end // 8)], bitorder="little")[start & 7 :][: end - start].astype(bool)
            if not more.any():
                break
            at, start = at[more], self._rank(level, start)
            end = start + len(at)
        return out


# --- Spark jobs -------------------------------------------------------------


def write_tokens(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, file_tokens: int = FILE_TOKENS, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encode all texts and write them in ascending order of doc_id.

    Gives the folder and a table (part, number, n_docs, n_tokens) of its files.  Null texts
    count as empty and get the end id alone; null ids come first; repeated rows are
    written each.  An empty table gives no files.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    make_folder(folder)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[f"`{doc_id}`"].cast("long").alias("d"), docs[f"`{text}`"].alias("t"))
    # With the text's hash, rows of one id, or of none, are many ranges too.
    rows = rows.repartitionByRange(n, "d", F.xxhash64("t")).sortWithinPartitions("d", F.xxhash64("t"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode_all, TaskContext.get().partitionId()
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        size, done = 0, []
        tail = np.array([end_id], np.uint32)

        def close() -> None:
            nonlocal size
            if names:
                put(f"{folder}/part-{part:06d}-{len(done):05d}.dac", pack(names, ids, part, len(done)))
                done.append((part, len(done), len(names), size))
            names.clear(), ids.clear()
            size = 0

        for batch in batches:
            for step in steps(batch, 1, LEARN_BYTES):
                texts = pc.fill_null(step.column(1), "")
                for d, got in zip(step.column(0).to_pylist(), encode(texts), strict=True):
                    names.append(d)
                    ids.append(np.concatenate([got, tail]))
                    size += len(ids[-1])
                    if size >= file_tokens:
                        close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.int64()) for i in range(4)], names=["part", "number", "n_docs", "n_tokens"])

    return folder, saved(rows.mapInArrow(write, "part long, number long, n_docs long, n_tokens long"), "token-files")


def read_tokens(folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    start counts the ids of all documents before; it is the sum of the parts before
    (one row a part in the only unpartitioned window), of the files before in the part,
    and of the documents before in the file.
    """
    spark = files.sparkSession
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("n_tokens")
    base = files.withColumn("inside", inside).join(parts, "part").select("part", "number", (F.col("before") + F.col("inside")).alias("base"))
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                f = TokenFile(blob.as_buffer())
                ends = f.ends.tolist()
                starts = [0, *ends[:-1]]
                ids = memoryview(f.slice(0, f.n_tokens).astype("<u4").tobytes())
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays([pa.array([f.part] * n, pa.int64()), pa.array([f.number] * n, pa.int64()), pa.array(f.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()), pa.array(crc, pa.int64())], names=["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32"])

    rows = stored.mapInArrow(read, "part long, number long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(base, ["part", "number"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    return read_tokens(*write_tokens(docs, tokenizer, **options))
