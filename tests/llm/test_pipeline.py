"""Each stage of the pipeline against brute force over its own input."""

import os
import zlib

import pytest

import corpus_pipeline
from barloom.llm import common, quality
from barloom.llm.common import saved
from barloom.llm.queries import tokenizer_file
from tests.conftest import SMALL
from tests.llm.test_texts import fingerprint, windows_of


def test_stages(spark):
    from tokenizers import Tokenizer

    table = lambda n: spark.read.parquet(f"{SMALL}/{n}.parquet")
    docs = table("documents")
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(saved(stage(spark, states[-1], SMALL), name.replace(" ", "-")))
    for before, after in zip(states[:4], states[1:5], strict=True):
        assert before.columns == after.columns
    rows = [{r.doc_id: r for r in s.collect()} for s in states]

    verdict = {r.doc_id: r.kept for r in quality.judge(docs, quality.train(docs, table("labels")), keep=["doc_id"]).collect()}
    assert set(rows[1]) == {d for d, kept in verdict.items() if kept}

    fps = {d: fingerprint(r.text) for d, r in rows[1].items()}
    group = {d: d for d in fps}
    for _ in range(10):
        for a in fps:
            group[a] = min(group[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 3)
    assert set(rows[2]) == {d for d in fps if group[d] == d}

    wanted = {w for r in table("benchmark").collect() for w in windows_of(r.text, 13)[1]}
    clean = set()
    for d, r in rows[2].items():
        w, hit = windows_of(r.text, 13)[0], set()
        for n in {len(x) for x in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(d)
    assert set(rows[3]) == clean

    assert set(rows[4]) == clean
    copies = {r.doc_id: r["count"] for r in states[4].groupBy("doc_id").count().collect()}
    assert max(copies.values()) <= 3

    plain, start = Tokenizer.from_file(tokenizer_file()), 0
    out = sorted(states[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted(d for d, n in copies.items() for _ in range(n))
    for r in out:
        ids = [*plain.encode(rows[3][r.doc_id].text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        start += len(ids)
    assert corpus_pipeline.ORACLE_SQL is None


CLASHING = ["__pass", "__place", "__copies", "doc", "fp", "h", "kept", "component_id", "t", "d", "row", "hash", "contaminated", "n_words", "a.b"]


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    """A folder of tables with nulls in every column, repeated rows, ties and columns of clashing names."""
    folder = str(tmp_path_factory.mktemp("edges"))
    table = lambda n: spark.read.parquet(f"{SMALL}/{n}.parquet")
    docs = table("documents").limit(60).collect()
    long = max((r.text for r in docs), key=len)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs]
    rows += [rows[3], rows[4], (rows[5][0], long, None, None, None), (None, rows[6][1], "en", None, 1), (None, None, None, None, None), (None, long + " and its end.", None, "s", None), (10**9, "", "en", "empty", 0), (10**9 + 1, " \n ", "en", "empty", 3), (10**9 + 2, long * 40, "en", "src1", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    spark.createDataFrame([(*r, *[f"{c}-{i}" for c in CLASHING]) for i, r in enumerate(rows)], schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(None, 1, 0), (1, None, None), *[(r.doc_id, r.quality, r.toxic) for r in table("labels").collect()]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(None, None), (3, None), (4, ""), (None, " ".join(long.split()[:40])), *[(r.item_id, r.text) for r in table("benchmark").collect()]]
    spark.createDataFrame(items, table("benchmark").schema).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_edge_rows_through_all_stages(spark, edges):
    docs = common.table(spark, edges, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(common.saved(stage(spark, seen[-1], edges), name.replace(" ", "-")))
    key = lambda r: tuple(r[c] for c in docs.columns)
    before = [[key(r) for r in s.collect()] for s in seen[:5]]
    for s, rows, earlier in zip(seen[1:5], before[1:], before, strict=False):
        assert s.columns == docs.columns and rows and set(rows) <= set(earlier)
    assert all(r[1] and r[1].split() for r in before[1])
    texts = {r[1] for r in before[1]}
    assert len(texts) - len({r[1] for r in before[2]}) < len(texts) / 2 and any(r[0] is None for r in before[2])
    assert sorted(r.n_tokens for r in seen[5].collect()) and seen[5].count() == len(before[4])
    assert set(before[4]) == set(before[3])


def test_empty_tables_through_all_stages(spark, edges, tmp_path):
    for n in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{edges}/{n}.parquet").limit(0).write.parquet(f"{tmp_path}/{n}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_leaves_only_its_results(spark, edges):
    root = common.work_dir(spark).removeprefix("file://")
    before = set(os.listdir(root))
    got = corpus_pipeline.run(spark, edges)
    left = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before)
    assert got.count() > 0 and left == ["token-files", "tokens"]


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError):
        common.work_dir(Session())
