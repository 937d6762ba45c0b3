"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are computed where the documents are and only (id, fingerprint) leaves
the task.  Equal fingerprints collapse first.  Distinct fingerprints are then put into
tiles by the population counts of their two 32-bit halves.  The sum of the differences
of these counts never exceeds the Hamming distance, so a pair of tiles whose counts
differ by more than the radius is skipped and nothing is lost.  A tile with more than
`TILE` fingerprints (a large group of near copies) is cut into pieces.  Tiles are files in
the shared folder; only the names of a pair are shuffled, and its task reads the files.
Pieces of a key are dealt in blocks, and a pair of blocks to one task, which so reads each
of its tiles once for up to `BLOCK` pairs.
Each surviving pair of tiles is compared in numpy by exclusive-or and bit counts, and
gives back only a spanning forest of its links, so dense groups stay linear in size.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, map_texts, new_folder, saved
from .components import connected
from .files import get, make_folder, put

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Most fingerprints in a tile, pieces in a block, and tiles that a task keeps in memory.
TILE, BLOCK, TILES_KEPT = 8192, 16, 128

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text; zero if it has no words."""
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for k, text in enumerate(texts):
        words = text.translate(_FOLD).split()
        if not words:
            continue
        joined = b" ".join(words)
        n = max(1, len(words) - SHINGLE + 1)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        end = np.cumsum(size) - 1
        begin = (end - size + 1)[:n].tolist()
        hashes = np.array([digest(joined[b:e], SEED) for b, e in zip(begin, end[-n:].tolist(), strict=True)], np.uint64)
        ones = np.zeros(64, np.int64)
        for i in range(0, n, 65536):
            ones += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprint(docs: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, then `fp`: the fingerprint as a signed long with the same bits."""
    return map_texts(docs, text, [T.StructField("fp", T.LongType())], lambda texts: [fingerprints(texts).view(np.int64)], keep)


def forest(a: np.ndarray, b: np.ndarray | None, radius: int, rows: int = 256) -> list[tuple[int, int]]:
    """Links within `a` (b: None), or within and between a and b, reduced to a spanning forest."""
    both = a if b is None else np.concatenate([a, b])
    other, offset = (a, 0) if b is None else (b, len(a))
    label = np.arange(len(both))
    links: list[tuple[int, int]] = []
    for i in range(0, len(a), rows):
        near = np.bitwise_count(a[i : i + rows, None] ^ other[None, :]) <= radius
        for r in np.flatnonzero(near.any(axis=1)).tolist():
            at = np.flatnonzero(near[r]) + offset
            roots, first = np.unique(label[at], return_index=True)
            own = label[i + r]
            for root, f in zip(roots.tolist(), first.tolist(), strict=True):
                if root != own:
                    links.append((int(both[i + r]), int(both[at[f]])))
                    label[label == root] = own
    return links


def store_tiles(distinct: DataFrame, tile: int) -> tuple[str, DataFrame]:
    """The folder of the tiles, and their names (x, y, piece); distinct: one column fp."""
    folder = new_folder(distinct.sparkSession, "tiles")
    make_folder(folder)
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    keyed = distinct.select("fp", low.alias("x"), (F.bit_count("fp") - low).alias("y"))
    sizes = keyed.groupBy("x", "y").count().withColumn("pieces", F.ceil(F.col("count") / tile))
    # At most 33 x 33 keys, so this broadcast holds 1,089 rows at most.
    cut = keyed.join(F.broadcast(sizes), ["x", "y"]).select("x", "y", F.pmod(F.xxhash64("fp"), F.col("pieces")).alias("piece"), "fp")

    def store(table: pa.Table) -> pa.Table:
        name = [table.column(c)[0].as_py() for c in ("x", "y", "piece")]
        put(tile_path(folder, *name), np.sort(table.column("fp").to_numpy()).astype("<i8").tobytes())
        return pa.table({c: pa.array([v], t) for c, v, t in zip(("x", "y", "piece"), name, (pa.int32(), pa.int32(), pa.int64()), strict=True)})

    return folder, saved(cut.groupBy("x", "y", "piece").applyInArrow(store, "x int, y int, piece long"), "tile-names")


def tile_path(folder: str, x: int, y: int, piece: int) -> str:
    return f"{folder}/{x:02d}-{y:02d}-{piece:08d}"


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect what fingerprints within the radius connect; distinct: one column fp."""
    spark = distinct.sparkSession
    folder, names = store_tiles(distinct, tile)
    ball = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if abs(i) + abs(j) <= radius and (i, j) >= (0, 0)]
    ball = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ball])
    around = names.select("*", F.explode(ball).alias("d")).select("x", "y", "piece", (F.col("x") + F.col("d.i")).alias("x2"), (F.col("y") + F.col("d.j")).alias("y2"))
    pairs = around.join(names.select(F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("piece").alias("piece2")), ["x2", "y2"]).where((F.col("x") != F.col("x2")) | (F.col("y") != F.col("y2")) | (F.col("piece") <= F.col("piece2")))

    def compare(batches):
        @lru_cache(maxsize=TILES_KEPT)
        def tile_of(x: int, y: int, piece: int) -> np.ndarray:
            return np.frombuffer(get(tile_path(folder, x, y, piece)), "<u8")

        for batch in batches:
            got: list[tuple[int, int]] = []
            for x, y, piece, x2, y2, piece2 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = (x, y, piece) == (x2, y2, piece2)
                got += forest(tile_of(x, y, piece), None if same else tile_of(x2, y2, piece2), radius)
            ends = np.array(got, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    # A pair of blocks has at most BLOCK x BLOCK pairs of tiles, so tasks differ little in size.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = lambda c: F.floor(F.col(c) / BLOCK)
    dealt = pairs.select("x", "y", "piece", "x2", "y2", "piece2").repartition(n, "x", "y", block("piece"), "x2", "y2", block("piece2"))
    near = dealt.sortWithinPartitions("x", "y", block("piece"), "x2", "y2", block("piece2"), "piece", "piece2")
    return near.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    component_id is the smallest id that a document reaches over links of at most
    `radius` differing bits.  Null and empty texts have the fingerprint zero and are
    linked like any other.  Repeated rows stay; a null id never is a component's
    smallest unless the component has no other.
    """
    hashed = saved(with_fingerprint(docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("t")), keep=["doc_id"], text="t"), "fingerprints")
    classes = saved(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    member = _roots(classes, radius, tile)
    named = member.join(classes, "fp").groupBy("root").agg(F.min("least").alias("component"))
    member = member.join(named, "root").select("fp", "component")
    # A written table, so that the last join has an exchange on both sides and adaptive
    # execution can split a fingerprint that very many documents share.
    whole = saved(classes.join(member, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id")), "component-ids")
    return hashed.join(whole, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _roots(classes: DataFrame, radius: int, tile: int) -> DataFrame:
    """(fp, root) of the fingerprints that have links."""
    return saved(connected(links(classes.select("fp"), radius, tile)), "roots").withColumnRenamed("node", "fp")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One document of each component: the one with the smallest id, with its own columns only.

    Where rows of one component share that id, the smallest hash of the text stays, and
    of rows with equal texts any.  Rows of other components stay even if they share it.
    Rows without an id all stay, as nothing can name the one of a group.
    """
    hashed = with_fingerprint(docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("t"), F.xxhash64(docs[f"`{text}`"]).alias("h")), keep=["doc_id", "h"], text="t")
    classes = saved(hashed.groupBy("fp").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h"))).alias("first")), "classes")
    whole = classes.join(_roots(classes, radius, tile), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    stay = saved(whole.where("first is not null").select(F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h")), "stay")
    h = free_name(docs, "h")
    rows = docs.withColumn(h, F.xxhash64(docs[f"`{text}`"]))
    rows = rows.join(stay, (rows[f"`{doc_id}`"] == stay["doc_id"]) & (rows[f"`{h}`"] == stay["h"]), "left_semi")
    return rows.dropDuplicates([doc_id, h]).drop(h).unionByName(docs.where(docs[f"`{doc_id}`"].isNull()))
