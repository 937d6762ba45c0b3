"""Recursions and running columns by parts of sequences against the whole sequences."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.expr import Expr, column
from barloom.functions.kernels import evaluate
from barloom.operators import registry as R
from barloom.plans import carried
from barloom.plans.features import compute, parts
from barloom.sources.bars import SCHEMA, TIME
from tests.test_features import made

STATEFUL = [k for k, e in R.every().items() if carried.rounds([e])]
ORDER = ["symbol", "trade_time"]


def with_gaps():
    """Sequences with days that lack, flat and silent bars, one of a single bar."""
    frames = [made(1100, 1, "a", flat=range(171, 199), quiet=[0, 83, 84, 219]), made(500, 2, "A"), made(1, 3, "one")]
    return pd.concat([f.drop(f.index[100:171]) if len(f) > 200 else f for f in frames])


def same(got, want, columns):
    for c in columns:
        np.testing.assert_array_equal(got[c].isna(), want[c].isna(), err_msg=c)
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_all_columns_that_carry_state(spark, monkeypatch):
    """Every one of them, by parts of some days and blocks of 32 rows."""
    monkeypatch.setattr(carried, "BLOCK_ROWS", 32)
    df = spark.createDataFrame(with_gaps(), SCHEMA)
    assert len(STATEFUL) == 155
    want = compute(df, columns=STATEFUL).orderBy(ORDER).toPandas()
    got = compute(df, columns=STATEFUL, split=200).orderBy(ORDER).toPandas()
    assert len(got) == len(want)
    # It divides by the range of a mean: where that has settled, the range is rounding and the quotient anything from 0 to 1.
    noisy = "tv_schaff_trend_cycle"
    same(got, want, [c for c in STATEFUL if c != noisy])
    assert np.isclose(got[noisy].astype(float), want[noisy].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True).mean() > 0.97


@pytest.mark.parametrize("rows", [1, 10_000])
def test_parts_of_a_day_and_of_all(spark, rows):
    columns = ["tv_obv", "tv_pvi", "tv_consecutive_up_bars", "excel_TEMA_20", "tv_psar_dir", "tv_ema_55", "wh6_u_a8b37c90_u_a8b37c90"]
    df = spark.createDataFrame(with_gaps(), SCHEMA)
    want = compute(df, columns=columns).orderBy(ORDER).toPandas()
    same(compute(df, columns=columns, split=rows).orderBy(ORDER).toPandas(), want, columns)


def scan(df, e, reads, rows=48, block=16):
    """One affine node over the columns reads, by parts, and the kernel's values."""
    places = parts(df.select("symbol", "timeframe", TIME), rows, 1)
    day = df.withColumn(carried.DAY, F.date_trunc("day", TIME)).join(places, ["symbol", "timeframe", carried.DAY])
    over = f"row_number() OVER (PARTITION BY symbol, timeframe, {carried.PART} ORDER BY {TIME}) - 1"
    placed = day.selectExpr("symbol", "timeframe", TIME, carried.PART, *(f"{c} AS i0_{j}" for j, c in enumerate(reads)), f"{over} AS r").selectExpr("*", f"CAST(floor(r / {block}) AS BIGINT) AS {carried.BLOCK}", f"r % {block} + 1 AS {carried.ROW}")
    return carried.scanned(placed, [carried.Scan(e, 0)]).orderBy(TIME).toPandas()[e.key].to_numpy(float)


@pytest.mark.parametrize("op, p", [("ema", (2 / 13, 5)), ("ema", (1.0, 1)), ("ewm", (0.5,)), ("wsma", (1 / 3,)), ("smooth", (7, 2)), ("cumsum", ()), ("masked", ()), ("compound", (1000.0,)), ("run", ())])
def test_each_scan_with_gaps(spark, monkeypatch, op, p):
    """Values that lack at the start, inside, for whole blocks and for a whole part; products with zeros and signs."""
    monkeypatch.setattr(carried, "BLOCK_ROWS", 16)
    r = np.random.default_rng(8)
    f = made(300, 6)
    x = r.normal(size=300)
    x[[0, 1, 2, 60, 61, *range(90, 150), 299]] = np.nan
    on = r.random(300) < 0.7
    on[200:260] = True
    if op == "compound":
        x = np.where(np.isnan(x), 0.01, x * 0.4)
        x[[40, 41]] = -1.5
        x[250] = -1.0
    f = f.assign(x=x, on=on)
    df = spark.createDataFrame(f).withColumn("x", F.expr("nanvl(x, CAST(NULL AS DOUBLE))"))
    reads = {"compound": ["x", "on"], "run": ["on"]}.get(op, ["x"])
    e = Expr(op, *(column(c) for c in reads), p=p)
    want = evaluate([e], {"x": x, "on": on})[0]
    np.testing.assert_allclose(scan(df, e, reads), want, rtol=1e-9, atol=1e-12)


def test_branching_recursions_bit_for_bit(spark, monkeypatch):
    """With a long run-up parts meet at once; with hardly any some must run again; the values are the same bytes."""
    f = made(900, 11).assign(atr=lambda d: (d.high - d.low).ewm(alpha=0.1, adjust=False).mean())
    f["top"], f["bottom"] = f.high.rolling(10).max(), f.low.rolling(10).min()
    df = spark.createDataFrame(f).withColumns({c: F.expr(f"nanvl({c}, CAST(NULL AS DOUBLE))") for c in ("top", "bottom")})
    h, low, c, atr = (column(x) for x in ("high", "low", "close", "atr"))
    nodes = {"sar": Expr("psar", h, low, c, p=(0.02, 0.2)), "sar_up": Expr("psar_up", h, low, c, p=(0.02, 0.2)), "line": Expr("supertrend", h, low, c, atr, p=(3.0,)), "way": Expr("supertrend_dir", h, low, c, atr, p=(3.0,)), "fish": Expr("fisher", c, column("top"), column("bottom")), "stop": Expr("utbot", c, atr), "signal": Expr("utbot_signal", c, atr)}
    reads = ["high", "low", "close", "atr", "top", "bottom"]
    want = evaluate(nodes.values(), {x: f[x].to_numpy(float) for x in reads})
    repeated = {}
    for back in (2, 300):
        places = parts(df, 72, back)
        own = places.where(carried.OWN).select("symbol", "timeframe", carried.DAY, carried.PART)
        rows = df.withColumn(carried.DAY, F.date_trunc("day", TIME)).join(own, ["symbol", "timeframe", carried.DAY])
        got, repeated[back] = carried.speculated(rows, places, nodes, reads)
        got = got.orderBy(TIME).toPandas()
        for name, values in zip(nodes, want, strict=True):
            assert got[name].to_numpy(float).tobytes() == np.asarray(values, float).tobytes() or np.array_equal(got[name].to_numpy(float), values, equal_nan=True), name
    assert repeated[2] and sum(repeated[300]) < sum(repeated[2])


def test_parts_are_tasks_and_scans_are_sql(spark, monkeypatch):
    """Rows of one sequence come from several tasks; affine columns need no Python."""
    monkeypatch.setattr(carried, "speculated", None)
    kept = []
    monkeypatch.setattr(carried, "stored", lambda df, name, real=carried.stored: kept.append(df) or real(df, name))
    df = spark.createDataFrame(made(1500, 4), SCHEMA)
    got = compute(df, columns=["tv_ema_21", "tv_obv", "excel_TEMA_20", "tv_rsi_14"], split=240)
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in [*kept, got]]
    assert not any("Python" in p or "Arrow" in p for p in plans[1:])


def test_empty_bars_by_parts(spark):
    assert compute(spark.createDataFrame([], SCHEMA), columns=["tv_ema_21", "tv_obv", "tv_psar_dir", "tv_sma_10"], split=100).count() == 0
