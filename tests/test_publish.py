import os

import pytest
from pyspark.sql import functions as F

from barloom.plans import publish as P
from barloom.plans.features import compute
from tests.conftest import SMALL

COLUMNS = ["tv_sma_10", "tv_ema_8", "excel_CLV"]
SCOPE = {"columns": COLUMNS}


@pytest.fixture(scope="module")
def bars(spark):
    from barloom.sources.bars import lineitem_bars

    rows = lineitem_bars(spark, SMALL).where("trade_time < '1995-09-01'")
    return rows.withColumn("symbol", F.when(F.col("symbol") == "N", "01").otherwise(F.col("symbol"))).cache()


def test_from_build_to_rollback(spark, bars, tmp_path):
    root = f"file://{tmp_path}/features"
    made = P.build(bars, root, "r1", **SCOPE)
    assert made.count() == bars.count() and {r.symbol for r in made.select("symbol").distinct().collect()} >= {"01", "R"}
    with pytest.raises(P.PublishError):
        P.build(bars, root, "r1", **SCOPE)
    with pytest.raises(P.PublishError):
        P.publish(spark, root, "r1")
    with pytest.raises(P.PublishError):
        P.current(spark, root)
    ready = P.finalize(bars, root, "r1", **SCOPE)
    assert ready["bars"] == bars.count() and ready["sequences"] == 3 and ready["cells"] == 3 * bars.count()
    plan = P.publish(spark, root, "r1")
    assert not plan["published"]
    with pytest.raises(P.PublishError):
        P.publish(spark, root, "r1", confirm="wrong")
    assert P.publish(spark, root, "r1", confirm=plan["ready"])["published"]
    assert P.current(spark, root).count() == bars.count()
    assert P.verify_live(bars, root, **SCOPE)["status"] == "PASS"
    for run in ("r2", "r3"):
        P.build(bars, root, run, **SCOPE)
        P.finalize(bars, root, run, **SCOPE)
        P.publish(spark, root, run, confirm=P.publish(spark, root, run)["ready"])
    assert [P.rollback(spark, root), P.rollback(spark, root)] == ["r2", "r1"]
    with pytest.raises(P.PublishError):
        P.rollback(spark, root)
    moved = bars.withColumn("close", F.col("close") + (F.col("symbol") == "R").cast("double") * 1e-9)
    live = P.verify_live(moved, root, **SCOPE)
    assert live["status"] == "FAIL" and not live["bars"] and not live["cells"] and live["files"] and live["ready"]


def test_wrong_values_are_not_finalised(spark, bars, tmp_path):
    root = f"file://{tmp_path}/f"
    P.build(bars, root, "r1", **SCOPE)
    rows = P.stored(spark, root, "r1").cache()
    rows.count()
    off = rows.withColumn("tv_sma_10", F.when(F.col("symbol") == "A", F.col("tv_sma_10") * (1 + 1e-14)).otherwise(F.col("tv_sma_10")))
    off.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("symbol", "timeframe", "year").parquet(f"{root}/builds/r2")
    bars_print = P.fingerprint(bars).withColumn("columns", F.lit(P.digest({"c": COLUMNS}))).withColumn("stamp", F.current_timestamp())
    bars_print.write.parquet(f"{root}/prints/r2")
    with pytest.raises(P.PublishError, match="not valid"):
        P.finalize(bars, root, "r2", **SCOPE)


def test_resume_computes_what_changed(spark, bars, tmp_path):
    root = f"file://{tmp_path}/f"
    P.build(bars.where("symbol <> 'R'"), root, "r", **SCOPE)
    with pytest.raises(P.PublishError):
        P.finalize(bars, root, "r", **SCOPE)
    corrected = bars.withColumn("close", F.when((F.col("symbol") == "A") & (F.col("trade_time") >= "1995-06-01"), F.col("high")).otherwise(F.col("close"))).cache()
    prints = P.fingerprint(corrected).withColumn("columns", F.lit(P.digest({"c": COLUMNS})))
    assert [tuple(r) for r in P.valid_sequences(spark, root, "r", prints).collect()] == [("01", "1day")]
    P.build(corrected, root, "r", resume=True, **SCOPE)
    assert P.stored(spark, root, "r").count() == bars.count()
    P.finalize(corrected, root, "r", **SCOPE)
    got = {(r.symbol, r.trade_time): r.tv_sma_10 for r in P.stored(spark, root, "r").collect()}
    assert got == {(r.symbol, r.trade_time): r.tv_sma_10 for r in compute(corrected, columns=COLUMNS).collect()}
    with pytest.raises(P.PublishError, match="not made from"):
        P.finalize(corrected, root, "r", columns=COLUMNS[:2])


@pytest.mark.parametrize("broken", [1, 2, 3])
def test_publication_that_breaks_off(spark, bars, tmp_path, monkeypatch, broken):
    """Broken off before each of its three records, a publication is undone or live, and readers see a whole build."""
    root = f"file://{tmp_path}/f"
    few = bars.where("symbol = 'A'")
    for run in ("r1", "r2"):
        P.build(few, root, run, **SCOPE)
        P.finalize(few, root, run, **SCOPE)
    P.publish(spark, root, "r1", confirm=P.publish(spark, root, "r1")["ready"])
    confirm, write, calls = P.publish(spark, root, "r2")["ready"], P.Store.write, []

    def breaks(self, *a, **k):
        calls.append(a)
        if len(calls) == broken:
            raise KeyboardInterrupt
        return write(self, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(P.Store, "write", breaks)
        with pytest.raises(KeyboardInterrupt):
            P.publish(spark, root, "r2", confirm=confirm)
    store = P.Store(spark, root)
    assert P.pointer(store)[1]["run"] == ("r2" if broken == 3 else "r1")
    assert P.recover(spark, root) == {1: [], 2: ["r2: UNDONE"], 3: ["r2: LIVE"]}[broken]
    assert P.recover(spark, root) == [] and P.current(spark, root).count() == few.count()
    if broken < 3:
        assert P.publish(spark, root, "r2", confirm=confirm)["published"]


def test_of_two_publishers_one_fails(spark, tmp_path):
    store = P.Store(spark, f"file://{tmp_path}/f")
    store.write("current-00000001.json", {"run": "a", "ready": "", "history": []})
    with pytest.raises(P.PublishError):
        store.write("current-00000001.json", {"run": "b", "ready": "", "history": []})
    assert P.pointer(store)[1]["run"] == "a"
    store.write("note.json", {"x": 1}, overwrite=True)
    store.write("note.json", {"x": 2}, overwrite=True)
    assert store.read("note.json") == {"x": 2} and not [n for n in store.names("") if n.startswith(".") and not n.endswith(".crc")]


def test_days_appended_to_a_build(spark, bars, tmp_path, monkeypatch):
    """An appended day passes the validation of every cell, bit for bit; one that broke off is undone and made again."""
    root, scope = f"file://{tmp_path}/f", {"columns": [*COLUMNS, "tv_psar_dir", "tv_obv", "wh6_MACD_MACD"]}
    until = lambda a, b: bars.where(f"trade_time >= '{a}' AND trade_time < '{b}'")
    P.build(until("1990-01-01", "1995-06-01"), root, "r1", **scope)
    with pytest.raises(P.PublishError, match="no pasts"):
        P.append(until("1995-06-01", "1995-06-02"), root, "r1", **scope)
    P.keep_pasts(until("1990-01-01", "1995-06-01"), root, "r1", **scope)
    for a, b in (("1995-06-01", "1995-06-05"), ("1995-06-05", "1995-07-20")):
        P.append(until(a, b), root, "r1", **scope)
        assert P.stored(spark, root, "r1").count() == until("1990-01-01", b).count()
    assert P.finalize(until("1990-01-01", "1995-07-20"), root, "r1", **scope)["bars"] == until("1990-01-01", "1995-07-20").count()
    with pytest.raises(P.PublishError, match="finalised"):
        P.append(until("1995-07-20", "1995-09-01"), root, "r1", **scope)
    P.branch(spark, root, "r1", "r2")
    # Broken off after the rows were written.
    monkeypatch.setattr(P, "_merged_prints", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        P.append(until("1995-07-20", "1995-09-01"), root, "r2", **scope)
    monkeypatch.undo()
    with pytest.raises(P.PublishError):
        P.finalize(bars, root, "r2", **scope)
    P.append(until("1995-07-20", "1995-09-01"), root, "r2", **scope)
    assert P.finalize(bars, root, "r2", **scope)["bars"] == bars.count()
    P.branch(spark, root, "r2", "r3")
    with pytest.raises(Exception, match="not later than its past"):
        P.append(until("1995-07-20", "1995-09-01"), root, "r3", **scope)


def test_a_file_changed_at_equal_size_is_rebuilt(spark, bars, tmp_path):
    root = f"file://{tmp_path}/f"
    P.build(bars, root, "r1", **SCOPE)
    stamps = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "f/builds/r1").rglob("*.parquet")}
    before = stamps()
    victim = next(p for p in sorted(before) if "symbol=01" in p)
    data = bytearray(open(victim, "rb").read())
    data[len(data) // 2] ^= 1
    open(victim, "wb").write(bytes(data))
    os.remove(os.path.join(os.path.dirname(victim), f".{os.path.basename(victim)}.crc"))
    with pytest.raises(P.PublishError):
        P.finalize(bars, root, "r1", **SCOPE)
    P.build(bars, root, "r1", resume=True, **SCOPE)
    after = stamps()
    kept = {p for p in before if "symbol=01" not in p}
    assert kept and all(after[p] == before[p] for p in kept) and not [p for p in before if "symbol=01" in p and p in after]
    assert P.finalize(bars, root, "r1", **SCOPE)["bars"] == bars.count()
