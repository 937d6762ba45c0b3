"""Ranked search, hard negatives and the byte network against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import bytenet, negatives, queries, ranking
from tests.conftest import SMALL

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def ranked(docs, items, top=10):
    """(item, rank, doc_id, score), one document at a time."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 10 + 90 * c.total() * n // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(terms(text)) if c[w])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return out


def random_texts(n, seed, vocabulary=60):
    r = np.random.default_rng(seed)
    known = [f"w{i}" if i % 5 else f"É{i}x" for i in range(vocabulary)]
    return [" ".join(r.choice(known, r.integers(1, 80), p=None if i % 3 else r.dirichlet(np.ones(vocabulary) * 0.2))) for i in range(n)]


def sort_key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("block, shard", [(4_000_000, 16_384), (300, 7)])
def test_ranking(spark, monkeypatch, block, shard):
    monkeypatch.setattr(ranking.shard_ends, "__defaults__", (shard, 400 if shard == 7 else 2_000_000))
    texts = random_texts(150, 1)
    docs = [*enumerate(texts), (None, texts[3]), (3, texts[3]), (7, None), (8, ""), (9, " -- \n"), (10, "İ ΣΑΣ W1,w1;W1 " * 200), (-4, "a'b 12:34 @x")]
    items = [(1, " ".join(f"w{i}" for i in range(60)) + " É5x ΣΑΣ"), (2, "w1 w1 W1"), (3, None), (4, ""), (None, "w2 w3"), (5, "unknown words"), (5, "b 12 x"), (6, texts[40]), (6, texts[40])]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, item_id string").repartition(5)
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, score int")
    got = ranking.search(df, bench, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=sort_key) == sorted(ranked(docs, items), key=sort_key)


def test_ranking_of_empty_tables(spark):
    df, bench = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranking.search(df.limit(0), bench).count() == 0
    assert ranking.search(df, bench.limit(0)).count() == 0
    assert ranking.search(df.select("doc_id", F.lit(None).cast("string").alias("text")), bench).count() == 0
    assert [tuple(r) for r in ranking.search(df, bench).collect()] == ranked([(1, "a b")], [(1, "a")])


def test_masks_and_bounds():
    """Masks of more terms than a word has bits; a search that ends early finds what scoring all finds."""
    r = np.random.default_rng(3)
    n, k = 900, 150
    there = r.random((n, k)) < 0.12
    row, term = np.nonzero(there)
    tf = r.integers(1, 9, len(row))
    weight = r.integers(0, 3000, k)
    shard = ranking.Shard(n, row, term, tf, r.integers(10, 300, n), weight)
    docs, group, bits = shard.masks(np.arange(len(shard.present)))
    assert (bits[:, group].T == there[docs][:, shard.present]).all() and bits.shape[1] == len({tuple(x) for x in there[docs].tolist()})
    import pyarrow as pa

    ids = pa.array(r.permutation(n))
    for wanted in (np.arange(0, k, 2), np.arange(5), np.array([149]), np.arange(k)):
        best, scored = shard.search(wanted, [], ids, 10)
        mark = np.zeros(k, bool)
        mark[wanted] = True
        every = shard.scores(np.arange(n), mark)
        assert best == sorted((-s, False, i) for s, i in zip(every.tolist(), ids.to_pylist(), strict=True) if s > 0)[:10]
        assert scored <= n
    assert scored < n
    best, scored = shard.search(np.array([149]), [(-(10**12), False, i) for i in range(10)], ids, 10)
    assert scored == 0 and best[0][2] == 0


# --- hard negatives ------------------------------------------------------------


def mined(rows, every, scale=256):
    """Rows (id, label, vector), one pair at a time."""
    whole = [(i, k, [math.floor(scale * x) for x in v]) for i, k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for n, (i, k, v) in enumerate(whole):
        if i is None or i % every:
            continue
        scores = [(min(max(sum(a * b for a, b in zip(v, w, strict=False)), -(1 << 63)), (1 << 63) - 1), j, g) for m, (j, g, w) in enumerate(whole) if m != n]
        for s, p, _ in sorted((x for x in scores if x[2] == k), key=order)[:5]:
            near = sorted((x for x in scores if x[2] != k and 80 * s <= 100 * x[0] <= 100 * s), key=order)[:5]
            out += [(i, p, rank, j, s, t) for rank, (t, j, _) in enumerate(near, 1)]
    return out


def vectors(n, seed, dim=12, groups=6):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(groups, dim))
    x = middle[r.integers(0, groups, n)] + 0.4 * r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, int(r.integers(0, 4)), v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("block, size", [(1024, 32 << 20), (3, 2000)])
def test_negatives(spark, block, size):
    rows = vectors(260, 4)
    odd = [(None, 1, rows[0][2]), (10, rows[10][1], rows[10][2]), (20, 3, rows[7][2]), (30, None, rows[1][2]), (40, 1, None), (50, 2, [0.1, None]), (60, 2, [float("nan")] * 12), (61, 2, [float("inf")] * 12), (63, 2, []), (65, 1, rows[5][2][:7]), (12, 1, [0.0] * 12)]
    df = spark.createDataFrame([(*r, "clash") for r in rows + odd], "vec_id long, label int, embedding array<double>, rank string").repartition(4)
    got = negatives.mine(df, anchor=F.col("vec_id") % 10 == 0, block_anchors=block, slice_bytes=size)
    want = mined(rows + odd, 10)
    assert len(want) > 100 and sorted(map(tuple, got.collect()), key=sort_key) == sorted(want, key=sort_key)


def test_negatives_of_large_numbers_and_empty_tables(spark):
    rows = [(i, i % 2, [1e12 * (i % 5), 3e9, -1e3 * i]) for i in range(21)] + [(22, 0, [1e200, 1.0, 1.0]), (23, 1, [1e300, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    got = negatives.mine(df, anchor=F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect()), key=sort_key) == sorted(mined(rows, 10), key=sort_key)
    assert negatives.mine(df.limit(0), anchor=F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine(df, anchor=F.lit(False)).count() == 0


def test_bounds_hold_and_save_work():
    x = np.array([[math.floor(256 * c) for c in v] for _, _, v in vectors(400, 9, groups=3)], float)
    anchors = negatives.Anchors(list(range(60)), np.zeros(60, np.int64), x[:60])
    assert sorted(anchors.order.tolist()) == list(range(60)) and (anchors.parent < 0).sum() == 1
    exact, asked = x @ x[:60].T, []

    def wanted(a, low, high):
        assert (low <= exact[:, a]).all() and (exact[:, a] <= high).all()
        found = high >= 40_000
        asked.append(found.sum())
        return found

    for a, pick, scores in negatives.scored(anchors, x, wanted):
        assert (scores == exact[pick, a]).all() and set(np.flatnonzero(exact[:, a] >= 40_000)) <= set(pick)
    assert sum(asked) < 0.8 * exact.size
    # The shortest tree, against Kruskal's.
    edges = sorted((float(np.linalg.norm(x[i] - x[j])), i, j) for i in range(60) for j in range(i))
    root, total = list(range(60)), 0.0
    for d, i, j in edges:
        if root[i] != root[j]:
            total, old = total + d, root[i]
            root = [root[j] if q == old else q for q in root]
    assert anchors.length.sum() == pytest.approx(total)


# --- the byte network ----------------------------------------------------------


def slow_probability(net, text):
    x = text
    marked = [any(i - lag - 3 >= 0 and x[i - 3 : i + 1] == x[i - 3 - lag : i + 1 - lag] for lag in range(2, 25)) if i >= 3 else False for i in range(len(x))]
    s = [b + 256 * m for b, m in zip(x, marked, strict=True)]
    n = max(1, -(-len(s) // bytenet.BLOCK))
    s += [bytenet.PAD] * (n * bytenet.BLOCK + bytenet.WIDTH - 1 - len(s))
    answer = lambda at: net.embedding[s[at : at + bytenet.WIDTH]].ravel() @ net.filters + net.bias
    length = min(n, 2) * bytenet.BLOCK
    chunks = [np.maximum(0, np.max([answer(k * bytenet.BLOCK + i) for i in range(0, length, bytenet.STRIDE)], axis=0)) for k in range(max(1, n - 1))]
    z = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)]) @ net.weights + net.base[0]
    return 1 / (1 + math.exp(-z))


def test_probabilities_against_one_place_at_a_time():
    net = bytenet.Net.new(5)
    texts = [b"", b"a", b"abcabcabcabc", b"x" * 256, b"y" * 257, bytes(range(256)) * 5, "é ß | ### ".encode() * 70, b"Ber Ber Ber und und und und"]
    got = net.probability(texts)
    np.testing.assert_allclose(got, [slow_probability(net, t) for t in texts], rtol=2e-5)
    np.testing.assert_allclose([net.probability([t])[0] for t in texts], got, rtol=1e-5)
    assert len(net.probability([])) == 0


def test_gradients_against_differences():
    net = bytenet.Net.new(6)
    texts, y, w = [b"", b"one two two two", b"abc " * 200, b"\xff\x00" * 300], np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 0.5])
    _, grads = bytenet.gradients(net, texts, y, w)
    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        was, losses = p[at], []
        for step in (5e-3, -5e-3):
            p[at] = was + step
            losses.append(bytenet.gradients(net, texts, y, w)[0])
        p[at] = was
        assert g[at] == pytest.approx((losses[0] - losses[1]) / 1e-2, rel=0.02)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    out = queries.op12_bytenet(spark, sf).join(truth, "doc_id").toPandas()
    assert out.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]
    assert out.score.between(0, 1).all() and ((out.score >= 0.3) == (out.predicted == 1)).all()
    held = out[out.held_out]
    for _, own in held.groupby("lang"):
        assert own[own.quality == 1].predicted.mean() >= 0.98
        assert own[own.quality == 0].predicted.mean() <= 0.15
    assert 1 - held[held.quality == 0].predicted.mean() >= 0.95


def test_network_edges(spark):
    rows = [(1, "good words here"), (2, "### | ###"), (None, "x"), (3, None), (4, ""), (5, "y " * 100_000), (1, "good words here")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (5, 0), (4, 1), (4, 0)], "doc_id long, quality int")
    model = bytenet.train(df, labels, max_bytes=1000)
    got = model.score(df, keep=["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id == 1}) == 1
    assert bytenet.train(df, labels.where("quality = 1")).score(df, keep=["doc_id"]).where("score = 0.5").count() == len(rows)
    assert bytenet.train(df.limit(0), labels).score(df.limit(0), keep=["doc_id"]).count() == 0
    assert queries.op12_bytenet(spark, SMALL).count() == 200
