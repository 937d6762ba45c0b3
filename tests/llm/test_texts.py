"""Operators on texts against brute force, with edge rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import decontaminate, mixing, passages, quality, queries, simhash, tokens, toxicity
from tests.conftest import SMALL, same_rows

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("t", T.StringType())])
rng = np.random.default_rng(5)
WORDS = ["".join(rng.choice(list("abcdeé"), rng.integers(2, 7))) for _ in range(300)]


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(WORDS, n)) + "."


def rows():
    shared, base = prose(70, 1), prose(400, 2)
    near = base.split()
    near[200] = "changed"
    texts = [None, "", " \n\t ", "one", prose(49, 3), prose(50, 4), prose(51, 5), base, base, " ".join(near), prose(30, 6) + " " + shared + " " + prose(40, 7), prose(5, 8) + "\n" + shared, shared, shared.upper(),
             "a " * 300, "same line here\n" * 40, prose(20_000, 9), "x" * 50_000, "the wide space " * 30, prose(60, 10) + " %%% | ### " * 30, "İstanbul ΣΑΣ " + prose(20, 11)]
    out = [(i, t, "en", "s0" if i % 3 else "s1", None, "clash", None) for i, t in enumerate(texts)]
    return [*out, out[7], (None, base, None, None, None, None, None), (-5, shared, "en", "s2", 1, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- decontamination ----------------------------------------------------------


def windows_of(text, size):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    n = min(size, len(w))
    return w, [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] if w else []


@pytest.mark.parametrize("block", [12_000_000, 180])
def test_decontamination(spark, docs, none, block):
    parts = rows()[16][1].split()
    items = [(1, " ".join(parts[100:130])), (2, "one"), (3, None), (None, "one"), (10, parts[5000] + " " + " ".join(parts[5001:5040]) + " zz"), (10, prose(20, 99)), (4, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in decontaminate.find_overlap(docs, bench, keep=["doc_id", "text"], block_bytes=block).collect():
        wanted = defaultdict(set)
        for item, text in items:
            if item is not None and text:
                for win in windows_of(text, 13)[1]:
                    wanted[win].add(item)
        w, hit, found = windows_of(r.text, 13)[0], set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        got[r.doc_id] = r
    assert got[16].longest_match == 40 and got[16].longest_start == 5000 and got[16].longest_item == "10"
    assert got[3].contaminated and got[3].longest_match == 1
    clean = decontaminate.remove_contaminated(docs, bench, block_bytes=block)
    assert clean.columns == docs.columns and clean.where("doc_id = 3").count() == 0 and clean.count() == docs.count() - 1
    assert decontaminate.remove_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.find_overlap(none, bench, keep=["doc_id"]).count() == 0


def test_items_without_an_id_contaminate(spark, docs):
    bench = spark.createDataFrame([(None, prose(30, 6)), (None, prose(40, 7)), (7, prose(49, 3))], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find_overlap(docs, bench, keep=["doc_id"]).where("doc_id in (4, 10)").collect()}
    assert got[10].contaminated and got[10].n_hit >= 70 and got[10].n_items == 0 and got[10].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[4].contaminated and got[4].n_items == 1


def test_suffix_array_is_sorted():
    r = np.random.default_rng(1)
    t = np.concatenate([r.integers(0, 4, 500), np.zeros(60, int)]).astype(np.int64)
    at = np.flatnonzero(t)
    got = decontaminate.suffix_array(t, at, 40, 2)
    assert sorted(got) == at.tolist()
    keys = [tuple(t[p : p + 40]) for p in got]
    assert keys == sorted(keys)


# --- quality -------------------------------------------------------------------


def test_quality_counts(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i not in (14, 15, 19))) for i in range(21)], "doc_id long, quality int")
    chain = quality.train(docs, labels)
    for r in quality.judge(docs, chain, keep=["doc_id", "text"]).collect():
        text = r.text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        lines, seen, dup = text.split("\n"), set(), 0
        for line in lines:
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in seen
                seen.add(line)
        count, inside = defaultdict(list), set()
        for i in range(len(w) - 4):
            count[tuple(w[i : i + 5])].append(i)
        for at in count.values():
            if len(at) > 1:
                inside |= {i + j for i in at for j in range(5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside))
        assert r.base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
        assert not (r.base_failed and r.kept)
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {5, 7, 16} <= {r.doc_id for r in kept.collect()}
    assert quality.filter_documents(none, labels).count() == 0
    assert quality.filter_documents(docs, labels.limit(0)).count() > 0


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    chain = quality.Chain(r.normal(size=(3, 2)), r.normal(size=(2, 2)), r.normal(size=2))
    x = r.normal(size=(9, 3))
    first = np.array([0, 4])
    got = chain.viterbi(x, first).astype(int)
    for b, e in ((0, 4), (4, 9)):
        best = max(np.ndindex(*[2] * (e - b)), key=lambda s: chain.start[s[0]] + sum((x[b + i] @ chain.weights)[k] for i, k in enumerate(s)) + sum(chain.step[a, c] for a, c in zip(s, s[1:], strict=False)))
        assert tuple(got[b:e]) == best


def test_training_reads_all_lines(spark):
    line = lambda i, j: prose(8, 1000 * i + j)
    head = [[line(i, j) for j in range(60)] for i in range(8)]
    good = [(i, "\n".join(h + [line(i, 100 + j) for j in range(20)])) for i, h in enumerate(head)]
    bad = [(10 + i, "\n".join(h + ["%% | ## | $$ home"] * 140)) for i, h in enumerate(head)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 10)) for d, _ in good + bad], "doc_id long, quality int")
    chain = quality.train(docs, labels)
    x = quality.lines_of([("\n".join(["%% | ## | $$ home"] * 30)).encode(), good[0][1].encode()])
    got = chain.viterbi(x.features, x.first)
    assert not got[:30].any() and got[30:].mean() > 0.9


def padded(sizes, seed=4, n_f=12):
    r = np.random.default_rng(seed)
    xs, signs, w = [r.normal(size=(n, n_f)) for n in sizes], [r.normal(size=n) for n in sizes], r.random(len(sizes))
    theta = [r.normal(size=(n_f, 2)), r.normal(size=(2, 2)), r.normal(size=2)]
    return xs, signs, w, theta


def test_gradient_does_not_depend_on_batches():
    sizes = sorted(np.random.default_rng(3).integers(1, 300, 40).tolist())
    xs, signs, w, theta = padded(sizes)
    ranges = quality.similar(sizes, 2000)
    assert [i for b, e in ranges for i in range(b, e)] == list(range(40)) and len(ranges) > 3
    some = [quality.gradient(theta, quality.Padded(xs[b:e], signs[b:e], w[b:e])) for b, e in ranges]
    for whole, parts in zip(quality.gradient(theta, quality.Padded(xs, signs, w)), zip(*some, strict=True), strict=True):
        assert np.allclose(whole, sum(parts))


def test_gradient_is_that_of_the_likelihood_summed_over_paths():
    xs, signs, w, theta = padded([1, 2, 4], n_f=3)

    def likelihood(theta):
        W, S, B = theta
        total = 0.0
        for x, sign, weight in zip(xs, signs, w, strict=True):
            score = lambda z: B[z[0]] + sum((x[i] @ W)[k] for i, k in enumerate(z)) + sum(S[a, c] for a, c in zip(z, z[1:], strict=False))  # noqa: B023, E731
            paths = list(np.ndindex(*[2] * len(x)))
            total += weight * (np.log(sum(np.exp(score(z) + sum(sign[i] for i, k in enumerate(z) if k)) for z in paths)) - np.log(sum(np.exp(score(z)) for z in paths)))
        return total

    got = quality.gradient(theta, quality.Padded(xs, signs, w))
    for i, part in enumerate(theta):
        for at in np.ndindex(*part.shape):
            moved = []
            for h in (1e-5, -1e-5):
                other = [t.copy() for t in theta]
                other[i][at] += h
                moved.append(likelihood(other))
            assert got[i][at] == pytest.approx((moved[0] - moved[1]) / 2e-5, abs=1e-6)


MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def halves(spark):
    """Verdicts on the labelled documents of sf0.01, each by a chain learned from the other half."""
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{n}.parquet") for n in ("documents", "labels"))
    out = []
    for k in (0, 1):
        chain = quality.train(docs, labels.where(f"doc_id % 2 = {1 - k}"))
        out.append(quality.judge(docs, chain, keep=["doc_id", "lang"]).join(labels.where(f"doc_id % 2 = {k}"), "doc_id").toPandas())
    return chain, pd.concat(out)


def test_bad_documents_of_every_language_go(halves):
    _, held = halves
    assert set(held[held.quality == 0].lang) == {"en", "de", "fr", "es"}
    for _, own in held.groupby("lang"):
        assert own[own.quality == 0].kept.mean() <= 0.1
        assert own[(own.quality == 1) & ~own.base_failed].kept.mean() > 0.97


def test_lines_of_mixed_pages_differ(halves):
    chain, held = halves
    judged = held[~held.base_failed]
    assert ((judged.content_share > 0) & (judged.content_share < 1)).any()
    said = ["The thing was on the other then and it had an end.", "And the rest of it, then, was there with the one that came.", "Of that the others were in the end not of one kind."] * 3
    said = [f"{x} {i}." for i, x in enumerate(said)]
    page = ["Home | About | Contact | Login | Terms", "BUY!! NOW!! CHEAP!! DEALS!! HERE!!", *said, "Home | Next | Previous | Last", "and&&& of%%% more*** links### here$$$"]
    junk = ["One line that is said in words before the rest, and then.", *["and&&& of%%% more*** links### here$$$ the&&&"] * 6]
    x = quality.lines_of(["\n".join(page).encode(), "\n".join(junk).encode()])
    got = chain.viterbi(x.features, x.first).astype(int).tolist()
    assert got == [0, 0, *[1] * 9, 0, 0, *got[13:14], *[0] * 6]


# --- tokens --------------------------------------------------------------------


def test_repeated_ids_lose_no_component(spark):
    a, b, c = prose(300, 21), prose(300, 22), prose(300, 23)
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b), (5, c), (4, c), (None, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(df).collect()) == sorted([(1, a), (1, b), (4, c), (0, c)])


def test_codes_round_trip():
    r = np.random.default_rng(3)
    ids = [r.integers(0, m, n).astype(np.uint32) for m, n in ((200, 700), (49_000, 1500), (1 << 31, 900), (5, 0), (300, 1))]
    f = tokens.TokenFile(tokens.pack([7, None, -3, 4, 5], ids, 2, 1))
    flat = np.concatenate(ids)
    assert f.doc_ids == [7, None, -3, 4, 5] and f.n_tokens == len(flat)
    assert [f.token(i) for i in range(0, len(flat), 37)] == flat[::37].tolist()
    for a, b in ((0, len(flat)), (511, 513), (699, 2400), (5, 5)):
        np.testing.assert_array_equal(f.slice(a, b), flat[a:b])
    with pytest.raises(ValueError):
        tokens.TokenFile(b"nothing at all")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_table(spark, docs, none, name):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file(name)
    plain = Tokenizer.from_file(path)
    got = sorted(tokens.token_table(docs, path, file_tokens=3000).collect(), key=lambda r: r.start)
    want = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in want]
    start = 0
    for r, w in zip(got, want, strict=True):
        ids = [*plain.encode(w[1] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokens.token_table(none, path).count() == 0


def test_pieces_encode_as_the_whole():
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    plain, fast = Tokenizer.from_file(path), tokens.Encoder(path)
    texts = ["It's don't, DON'T!! he'll", "a<|endoftext|>b <|endoftext|>. c", "é É ́x ﬁ ²³ 12,5% ...", "ΑΣ ς Σ. İI ı", "\x1cx\x85y　z\r\nq", "über,. Straße!? Ça*#", "日本語 текст, ok"]
    for t in texts:
        assert fast.encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids


# --- SimHash -------------------------------------------------------------------


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("tile", [4096, 4])
def test_simhash(spark, docs, none, tile):
    got = simhash.near_duplicates(docs, tile=tile).collect()
    want = [(r[0], fingerprint(r[1])) for r in rows()]
    root = list(range(len(want)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(want)):
        for j in range(i):
            if (want[i][1] ^ want[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(want):
        groups[find(i)].append(d)
    least = [(d, f"{fp:016x}", min(x for x in groups[find(i)] if x is not None)) for i, (d, fp) in enumerate(want)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(least, key=key)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({x[2] for x in least if x[0] is not None})
    assert simhash.near_duplicates(none).count() == 0


def test_chains_and_dense_groups(spark):
    base = 0x0F0F_3333_5555_00FF
    fps = {base} | {base ^ (1 << i) for i in range(64)} | {base ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)}
    chain = [0]
    for i in range(0, 60, 3):
        chain.append(chain[-1] | 7 << i)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in {*fps, *chain}], "fp long")
    found = simhash.connected(simhash.links(df, tile=16)).collect()
    roots = defaultdict(set)
    for r in found:
        roots[r.root].add(r.node)
    assert sorted(map(len, roots.values())) == sorted([len(fps), len(chain)])


# --- passages ------------------------------------------------------------------


def removed(rows_, window=50):
    first = {}
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t, *_ in rows_]
    for (d, *_), w in zip(rows_, split, strict=True):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(d, first.get(k, d))
    out = []
    for (d, *_), w in zip(rows_, split, strict=True):
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < d:
                    gone |= set(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [100_000, 3])
def test_passages(spark, docs, none, shard):
    got = [tuple(r) for r in passages.dedup(docs, shard_phrases=shard).drop("kept").collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(removed(rows()), key=key)
    assert passages.dedup(none).count() == 0


def test_passages_of_few_words(spark):
    r = np.random.default_rng(8)
    rows_ = [(i, " ".join(r.choice(["a", "b"], r.integers(0, 90)))) for i in range(60)]
    rows_ += [(i + 100, " ".join(r.choice(["a", "b", "c"], 40)) + " " + " ".join(["k"] * r.integers(1, 60))) for i in range(30)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    for window, phrase in ((12, 4), (8, 8), (5, 1)):
        got = [tuple(x) for x in passages.dedup(df, window=window, phrase=phrase).drop("kept").collect()]
        assert sorted(got) == sorted(removed(rows_, window))


def test_passages_whose_owner_is_read_alone(spark):
    """Tasks that find recurring phrases but nothing to remove, and the other way round."""
    shared = prose(120, 31)
    texts = [(i, prose(60, 40 + i) + " " + shared if i in (0, 7) else prose(200, 40 + i)) for i in range(8)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartitionByRange(8, "doc_id")
    assert sorted(tuple(x) for x in passages.dedup(df).drop("kept").collect()) == sorted(removed(texts))


def test_word_hashes_tell_words_apart():
    texts = ["", "a a\0 a\0\0 b", " \n", "x" * 7 + " " + "x" * 8 + " " + "x" * 9 + " é ée " + "y" * 5000 + " " + "y" * 5001, "a"]
    h, n = passages.word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in re.findall("[^\x20\x09-\x0d]+", t)]
    assert n.tolist() == [0, 4, 0, 7, 1] and len(h) == len(words)
    assert len({w: x for w, x in zip(words, h.tolist(), strict=True)}) == len(set(words)) == len(set(h.tolist()))
    assert h[0] == h[-1]


# --- toxicity ------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    """Nine of ten toxic documents are found in each of the four languages, and few others."""
    sf = "/root/testdata/sf0.1"
    out = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert held.score.between(0, 1).all()
    assert ((held.score >= 0.3) == (held.predicted == 1)).all()
    assert set(held.lang) == {"en", "de", "es", "fr"}
    for _, own in held.groupby("lang"):
        assert own[own.toxic == 0].predicted.mean() < 0.02
        assert own[own.toxic == 1].predicted.mean() >= 0.9


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.score(docs, keep=["doc_id"]).count() == docs.count()
    assert toxicity.train(none, labels).score(none, keep=["doc_id"]).count() == 0
    lexicon = toxicity.Lexicon(toxicity._FIXED, {b"lowe*": 2.0, b"bad": 1.0})
    x = dict(zip(toxicity.FEATURES, toxicity.features(b"You IDIOT, you are an i-d-i-o-t and lowentum bad!!", lexicon), strict=True))
    assert x["fixed_hits"] == pytest.approx(np.log1p(1)) and x["near_you"] > 0 and x["learned_hits"] == pytest.approx(np.log1p(2)) and x["obfuscated_hits"] > 0
    assert len(toxicity.features(b"", lexicon)) == len(toxicity.FEATURES)


def slow_features(text, lexicon):
    """The 18 features, one word and one character at a time."""
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    n_bytes = lambda t: len(t.encode())
    words = re.findall("[a-z0-9'\x80-\U0010ffff]+", fold(text))
    n, size = max(1, len(words)), max(1, n_bytes(text))

    def weight(w):
        b, found = w.encode(), [0.0]
        for unit, x in lexicon.learned.items():
            if unit == b or unit.endswith(b"*") and len(unit) - 1 in (4, 5, 6, 7) and b.startswith(unit[:-1]):
                found.append(x)
        return max(found)

    insults, second = toxicity.INSULTS, toxicity.SECOND_PERSON
    hits, you = [i for i, w in enumerate(words) if w in insults], [i for i, w in enumerate(words) if w in second]
    weights = [weight(w) for w in words if weight(w) > 0]
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    shouted = sum(len(w.encode()) > 2 and w.encode().isupper() for w in re.findall("[^\x20\x09-\x0d]+", text)) if upper > 0.05 * max(1, upper + lower) else 0
    spelled = r"(?<![a-z])(?:[a-z][ .\-_]){3,}[a-z](?![a-z])"
    masked = r"[a-z\x80-\U0010ffff]+[0-9@$!*#_.\-]+[a-z\x80-\U0010ffff][a-z0-9@$!*#\x80-\U0010ffff]*"
    hidden = re.findall(f"{spelled}|{masked}", fold(text)) if words else []
    squeeze = lambda w: re.sub(r"(.)\1+", r"\1", w)
    plain = [squeeze(re.sub("[^a-z\x80-\U0010ffff]", "", "".join({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "@": "a", "$": "s", "!": "i", "7": "t"}.get(c, c) for c in h))) for h in hidden]
    known = {squeeze(w) for w in insults} | set(insults)
    count = lambda cs: sum(c in cs for c in text)
    return [
        np.log1p(len(words)), 100 * len(hits) / n, np.log1p(len(hits)), 100 * len(weights) / n, np.log1p(len(weights)), 100 * sum(weights) / n,
        np.log1p(sum(any(abs(i - j) <= 6 for j in you) for i in hits)), 100 * len(you) / n, upper / max(1, upper + lower), shouted / n, 100 * count("!?") / size, 100 * count(".,;:!?'\"()-") / size,
        100 * len(hidden) / n, np.log1p(sum(p in known or p.encode() in lexicon.learned for p in plain)), 100 * count("#*$%&|") / size, size / n, max(weights, default=0.0), np.log1p(sum(weights)),
    ]


def test_features_against_one_word_at_a_time(spark):
    lexicon = toxicity.Lexicon(toxicity._FIXED, {b"lowe*": 2.0, b"bad": 1.0, "dépl".encode() + b"*": 3.0, b"theretofo*": 9.0, b"idiot": 0.5})
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()][:80]
    texts += ["", " ", "You IDIOT, you are an i-d-i-o-t and lowentum bad!!", "st0pid sh1t m.o.r.o.n @$$hole f.u.c.k", "LOUD ÉCOLE DÉPLOIE déplaît crétin toi", "a1b2c3 x@y.z 'tis it''s", "pute you " * 30, "no you here idiot " + "w " * 7 + "you", "\x00 idiot\x7f"]
    for t in texts:
        np.testing.assert_allclose(toxicity.features(t.encode(), lexicon), slow_features(t, lexicon), rtol=1e-12, err_msg=t[:60])


# --- mixing --------------------------------------------------------------------


def test_mixing_meets_its_targets(spark):
    table = [(i, "w " * (1 + i % 40), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    tokens_of = defaultdict(int)
    for _, t, s in table:
        tokens_of[s] += len(t.split())
    total = sum(tokens_of.values())
    for target, limit, budget in ((0.9, None, None), (0.99, 2.0, None), (None, 1.5, None), (0.95, None, 20_000), (None, None, None)):
        mixed, sources = mixing.mix(df, target_entropy=target, max_repeats=limit, budget=budget)
        w = {r.source: r for r in sources.collect()}
        used = defaultdict(int)
        for r in mixed.collect():
            used[r.source] += len(r.text.split())
        p = np.array([w[s].weight for s in tokens_of])
        assert p.sum() == pytest.approx(1)
        alpha = w["hot"].exponent
        share = np.array([tokens_of[s] / total for s in tokens_of]) ** alpha
        np.testing.assert_allclose(p, share / share.sum(), rtol=1e-9)
        entropy = -(p * np.log(p)).sum() / np.log(len(p))
        if target and not limit:
            assert entropy == pytest.approx(target, abs=1e-6) or entropy >= target
        for s in tokens_of:
            assert -40 <= used[s] - w[s].budget <= 1e-6
            if limit:
                assert used[s] / tokens_of[s] <= limit + 1e-6
        if budget is None:
            assert len({r.doc_id for r in mixed.select("doc_id").distinct().collect()}) == len(table)
            assert used["hot"] == tokens_of["hot"]
        elif budget:
            assert sum(used.values()) == pytest.approx(budget, abs=300)


def test_mixing_edges(spark, docs, none):
    mixed, _ = mixing.mix(docs)
    assert {r.doc_id for r in mixed.collect()} == {r[0] for r in rows()}
    assert mixed.select(*docs.columns).columns == docs.columns
    assert mixing.mix(none)[0].count() == 0


def test_mixing_of_columns_with_clashing_names(spark):
    names = ["doc_id", "text", "source", "__pass", "__place", "__copies", "__block", "__hash", "__source", "__passes", "__extra", "__cut", "doc", "s", "h", "b", "pass", "copies", "digits", "place", "cut", "a.b"]
    rows_ = [(i, "w " * (i % 7), f"s{i % 3}", *[f"{n}{i}" for n in names[3:]]) for i in range(60)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names[3:]))
    mixed, _ = mixing.mix(df)
    assert mixed.columns == [*names, "__pass_", "__place_"]
    assert {tuple(r)[: len(names)] for r in mixed.collect()} == set(rows_)


@pytest.mark.parametrize("block_docs", [2, 1 << 20])
def test_blocks_grow_with_a_source(spark, block_docs):
    """The same budgets, met to a document, with blocks of three digits and of two."""
    df = spark.createDataFrame([(i, "w " * (1 + i % 9), "hot" if i % 4 else "s") for i in range(4000)], "doc_id long, text string, source string")
    mixed, sources = mixing.mix(df, target_entropy=1.0, max_repeats=None, budget=9000, block_docs=block_docs)
    used = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.n_tokens(F.col("text"))).alias("n")).collect()}
    for r in sources.collect():
        assert r.digits == (3 if block_docs == 2 and r.source == "hot" else 2 if block_docs > 2 or r.source == "hot" else r.digits)
        assert r.budget - 9 <= used[r.source] <= r.budget + 1e-6


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    same_rows(queries.queries()[name](spark, SMALL), queries.oracle_sql()[name])
