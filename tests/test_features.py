"""Features as Spark windows against the kernels, and their edges."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.kernels import evaluate
from barloom.functions.sql import reach
from barloom.operators import registry as R
from barloom.plans import audit
from barloom.plans.features import abreast, compute, live_only, parts, sql_text
from barloom.sources import bars as B
from barloom.sources.bars import NUMBERS, SCHEMA
from tests.conftest import SMALL


def made(n, seed=0, symbol="a", start="2019-12-01", flat=(), quiet=()):
    """A seeded random walk; rows of `flat` have one price, rows of `quiet` no volume."""
    r = np.random.default_rng([seed, 77])
    close = 60 * np.exp(r.normal(0, 0.01, n).cumsum())
    open_ = close * np.exp(r.normal(0, 0.004, n))
    high, low = np.maximum(open_, close) + r.gamma(2.0, 0.2, n), np.minimum(open_, close) - r.gamma(2.0, 0.2, n)
    volume, interest = r.integers(40, 900, n).astype(float), 3000 + r.integers(-30, 31, n).cumsum().astype(float)
    for i in flat:
        open_[i] = high[i] = low[i] = close[i]
    for i in quiet:
        volume[i] = 0
    when = [dt.datetime.fromisoformat(start) + dt.timedelta(hours=i) for i in range(n)]
    return pd.DataFrame({"symbol": symbol, "timeframe": "1h", "trade_time": when, "open": open_, "high": high, "low": low, "close": close, "volume": volume, "open_interest": interest})


@pytest.fixture(scope="module")
def bars(spark):
    frames = [made(300, 1, "a", flat=range(171, 199), quiet=[0, 83, 84, 219]), made(260, 2, "A"), made(1, 3, "one")]
    return spark.createDataFrame(pd.concat(frames), SCHEMA).cache(), frames


@pytest.mark.parametrize("name", R.FAMILIES)
def test_windows_equal_kernels(bars, name):
    df, frames = bars
    wanted = R.family(name)
    got = compute(df, families=(name,)).toPandas().sort_values(["symbol", "trade_time"])
    assert list(got.columns) == ["symbol", "timeframe", "trade_time", *wanted]
    for f in frames:
        want = evaluate(wanted.values(), {c: f[c].to_numpy(float) for c in NUMBERS})
        own = got[got.symbol == f.symbol[0]]
        for column, values in zip(wanted, want, strict=True):
            have = own[column].to_numpy(float)
            assert not np.isinf(have).any()
            np.testing.assert_array_equal(np.isnan(have), np.isnan(values), err_msg=column)
            np.testing.assert_allclose(have, values, rtol=1e-7, atol=1e-6, err_msg=column)


def test_sizes_and_order():
    assert [len(R.family(f)) for f in R.FAMILIES] == [198, 59, 66, 142]
    assert len(R.every()) == 465
    with pytest.raises(ValueError):
        R.select(["nothing"])
    with pytest.raises(ValueError):
        R.select(["wh6_MA_MA1", "wh6_MA_MA1"])


def test_one_exchange_for_all_windows(bars):
    df, _ = bars
    plan = compute(df, columns=["tv_hma_21", "wh6_DMI_ADXR", "excel_TMA_20"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan


def test_reach():
    want = {"tv_sma_10": 10, "tv_stoch_d_3": 16, "excel_TMA_20": 39, "tv_ema_8": None, "tv_obv": None}
    assert reach(R.select(list(want))) == want


@pytest.mark.parametrize("rows", [1, 60, 10_000])
def test_parts_of_sequences(bars, rows):
    """A fifth of the columns without recursion, in parts shorter than a frame, of some days, and of all."""
    df, frames = bars
    gaps = pd.concat([f.drop(f.index[100:171]) if len(f) > 200 else f for f in frames])
    df = df.sparkSession.createDataFrame(gaps, SCHEMA)
    columns = [*[k for k, e in R.every().items() if not e.scan and k != "tv_obv"][::5], "tv_obv", "tv_ema_8"]
    order = ["symbol", "trade_time"]
    want = compute(df, columns=columns).orderBy(order).toPandas()
    got = compute(df, columns=columns, split=rows).orderBy(order).toPandas()
    pd.testing.assert_frame_equal(got, want, rtol=1e-7, atol=1e-6)


def test_parts_are_more_tasks(spark):
    df = spark.createDataFrame(made(24 * 60, 4), SCHEMA)
    places = parts(df, 240, 30).toPandas()
    own = places[places["__own"]]
    assert len(own) == 60 and own["__part"].nunique() == 6
    before = places[~places["__own"]]
    assert (before.groupby("__part").size() == 2).all() and len(before) == 10  # 29 rows are parts of two days
    assert parts(df, 240, 1).where("NOT __own").count() == 0
    assert parts(df.limit(0), 240, 30).count() == 0


def test_flat_candles(spark):
    """A candle without a range has no place for its close: what frames it lacks a value, the running sum stands still."""
    f = made(90, 5, flat=[37])
    df = spark.createDataFrame(f, SCHEMA)
    got = compute(df, columns=["tv_cmf_20", "tv_eom_14", "tv_adl"]).orderBy("trade_time").toPandas()
    for column, n in (("tv_cmf_20", 20), ("tv_eom_14", 14)):
        missing = np.flatnonzero(got[column].isna())
        assert [i for i in missing if i > n] == list(range(37, 37 + n))
    assert got.tv_adl[37] == got.tv_adl[36] != got.tv_adl[38]


def test_silent_bar_in_the_short_line(spark):
    """A quotient by a volume of zero is infinite, counts as negative and empties the sums after it."""
    f = made(48, 9, quiet=[22])
    got = compute(spark.createDataFrame(f, SCHEMA), columns=["wh6_QHLSR_QHL5", "wh6_QHLSR_QHL10"]).orderBy("trade_time").toPandas()
    c, h, low, v = (f[x].tolist() for x in ("close", "high", "low", "volume"))
    line = [math.nan] * 2
    for i in range(2, 48):
        num = (v[i] - v[i - 1]) * (h[i - 1] - low[i - 1])
        line.append(c[i] - c[i - 1] - (num / v[i - 1] if v[i - 1] else math.copysign(math.inf, num)))
    num1 = (v[1] - v[0]) * (h[0] - low[0])
    line[1] = c[1] - c[0] - num1 / v[0]
    for i in range(48):
        for n, have in ((5, got.wh6_QHLSR_QHL5[i]), (10, got.wh6_QHLSR_QHL10[i])):
            own = line[max(0, i - n + 1) : i + 1]
            up, down = sum(x for x in own if x > 0), -sum(x for x in own if x < 0)
            if len(own) < n:
                want = math.nan
            elif n == 5 and all(x > 0 for x in own):
                want = 1.0
            elif n == 5 and all(x < 0 for x in own):
                want = 0.0
            else:
                want = math.nan if math.inf in (up, down) else up / (up + down)
            assert have == pytest.approx(want, nan_ok=True), (i, n)
    assert got.wh6_QHLSR_QHL10[23:33].isna().all() and got.wh6_QHLSR_QHL10[[22, 33]].notna().all()


def test_first_rows(spark):
    df = spark.createDataFrame(made(160), SCHEMA)
    got = compute(df, columns=["excel_EXPMA_12", "excel_PAC_upper_20", "wh6_ATR_ATR", "indicator_py_atr_norm", "tv_obv", "tv_pvi", "wh6_u_a8b37c90_u_a8b37c90"]).orderBy("trade_time").toPandas()
    f = made(160)
    assert got.excel_EXPMA_12[0] == f.close[0] and got.excel_PAC_upper_20[0] == f.high[0]
    assert got.wh6_ATR_ATR.first_valid_index() == 14 and got.indicator_py_atr_norm.first_valid_index() == 13
    assert got.tv_obv[0] == 0 and got.tv_pvi[0] == 1000 and (got.wh6_u_a8b37c90_u_a8b37c90 == 50).all()


def test_past_does_not_depend_on_the_future(spark):
    f = made(120)
    columns = list(R.every())[::7]
    whole = compute(spark.createDataFrame(f, SCHEMA), columns=columns).orderBy("trade_time").toPandas()
    part = compute(spark.createDataFrame(f[:70], SCHEMA), columns=columns).orderBy("trade_time").toPandas()
    pd.testing.assert_frame_equal(part, whole[:70], rtol=1e-9)


def test_warm_up(spark):
    df = spark.createDataFrame(made(400), SCHEMA)
    columns = ["tv_obv", "tv_adl", "tv_ema_21", "excel_OSC_40"]
    live = df.where("trade_time >= '2019-12-10'")
    got = live_only(df, live, start="2019-12-10", columns=columns).orderBy("trade_time").toPandas()
    want = compute(df, columns=columns).where("trade_time >= '2019-12-10'").orderBy("trade_time").toPandas()
    pd.testing.assert_frame_equal(got, want, rtol=1e-9)
    cold = live_only(df.limit(0), live, start="2019-12-10", columns=columns, cold_start=True).orderBy("trade_time").toPandas()
    assert (cold.tv_obv != got.tv_obv).any()
    with pytest.raises(ValueError):
        live_only(df.limit(0), live, start="2019-12-10", columns=columns)
    with pytest.raises(ValueError):
        live_only(df, df, start="2019-12-10", columns=columns)


def test_boundary_in_a_zone(spark):
    df = spark.createDataFrame(made(60, start="2019-12-31"), SCHEMA)
    live = df.where("trade_time >= '2019-12-31 16:00:00'")
    got = live_only(df, live, start="2020-01-01", zone="Asia/Shanghai", columns=["tv_sma_10"])
    same = live_only(df, live, start="2020-01-01T00:00:00+08:00", columns=["tv_sma_10"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, same.collect())) and got.count() == live.count() == 44
    with pytest.raises(ValueError):
        live_only(df, live, start="2020-01-01", columns=["tv_sma_10"])


def test_needless_cold_start(spark):
    df = spark.createDataFrame(made(60), SCHEMA)
    live = df.where("trade_time >= '2019-12-02'")
    with pytest.raises(ValueError):
        live_only(df, live, start="2019-12-02", cold_start=True, families=("excel",))
    assert live_only(df, live, start="2019-12-02", cold_start=True, columns=["tv_sma_10"]).count() == 36


def test_identity_of_a_sequence(spark):
    one, other = (spark.createDataFrame(made(5, symbol=x), SCHEMA) for x in "ab")
    assert B.one_sequence(one).count() == 5
    for bad in (one.unionByName(other), one.limit(0).unionByName(one.selectExpr("CAST(NULL AS STRING) AS symbol", *[c for c in one.columns if c != "symbol"]))):
        with pytest.raises(ValueError):
            B.one_sequence(bad)


def test_empty_bars(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert compute(df, columns=["tv_ema_21", "tv_sma_10"]).count() == 0


def test_second_engine(spark, bars):
    import duckdb

    df, frames = bars
    con = duckdb.connect()
    con.register("b", pd.concat(frames))
    columns = [c for c, e in R.family("tv").items() if not e.scan][:40]
    want = con.sql(sql_text("SELECT * FROM b", columns)).df().sort_values(["symbol", "trade_time"]).reset_index(drop=True)
    got = compute(df, columns=columns).toPandas().sort_values(["symbol", "trade_time"]).reset_index(drop=True)
    for c in columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-7, atol=1e-7, err_msg=c)


def test_audit_finds_changes(bars):
    df, _ = bars
    right = compute(df, columns=["tv_sma_10", "excel_CLV"])
    assert audit.rollup(audit.compare(right, right)).first().status == "PASS"
    wrong = right.selectExpr("symbol", "timeframe", "trade_time", "CASE WHEN symbol = 'A' THEN tv_sma_10 + 1 ELSE tv_sma_10 END AS tv_sma_10", "excel_CLV").where("symbol <> 'one'")
    report = {r.column: r for r in audit.compare(right, wrong).collect()}
    assert report["tv_sma_10"].status == "FAIL" and report["tv_sma_10"].beyond == 251 and report["tv_sma_10"].missing == 1
    assert audit.missing_sequences(right, wrong).first().symbol == "one"


def test_exact_quantiles_and_bits(spark):
    """p99 of differences as numpy tells it, over many sizes of numbers; signed zeros are not identical."""
    r = np.random.default_rng(3)
    f = made(777)
    f["x"] = r.normal(size=777) * 10.0 ** r.integers(-12, 13, 777)
    f["y"] = f.x + r.normal(size=777) * 10.0 ** r.integers(-20, 6, 777)
    f["z"], f["w"] = 0.0, np.where(np.arange(777) % 100 == 0, 1e-300, 0.0)
    f.loc[[5, 6], "x"] = np.nan
    keys = ["symbol", "timeframe", "trade_time"]
    df = spark.createDataFrame(f).withColumn("x", F.expr("nanvl(x, CAST(NULL AS DOUBLE))")).repartition(5)
    left = df.selectExpr(*keys, "x AS p", "z AS q", "z AS s", "CAST(NULL AS DOUBLE) AS t")
    right = df.selectExpr(*keys, "y AS p", "-z AS q", "w AS s", "CAST(NULL AS DOUBLE) AS t")
    got = {r.column: r for r in audit.compare(left, right, absolute=0.0, relative=0.0).collect()}
    gap = (f.x - f.y).abs().dropna()
    share = gap / f.x.abs().dropna()
    assert got["p"].p99_abs == pytest.approx(np.percentile(gap, 99), rel=1e-12) and got["p"].p99_rel == pytest.approx(np.percentile(share, 99), rel=1e-12)
    assert got["p"].max_abs == gap.max() and got["p"].null_mismatches == 2 and got["p"].n_cells == 777
    assert got["q"].not_identical == 777 and got["q"].beyond == 0 and got["q"].p99_abs == 0.0 and got["q"].p99_rel is None
    assert got["s"].p99_abs == np.percentile(np.abs(f.w), 99) and got["s"].beyond == 8
    assert got["t"].not_identical == 0 and got["t"].max_abs is None and got["t"].p99_abs is None and got["t"].status == "PASS"
    none = audit.compare(left.limit(0), right.limit(0))
    assert {r.n_cells for r in none.collect()} == {0} and none.count() == 4


def test_bar_rules(spark):
    f = made(30)
    f.loc[5, "high"] = 0
    f.loc[6, "close"] = np.nan
    f.loc[7, "volume"] = -1
    f.loc[9, "trade_time"] = f.trade_time[8]
    row = B.violations(spark.createDataFrame(f, SCHEMA)).first()
    assert (row.n_bars, row.unordered, row.unfit, row.outside, row.negative) == (30, 1, 1, 1, 1)


def test_scope(bars):
    df, _ = bars
    assert B.scoped(df, symbols=["A"]).count() == 260
    for symbols in ([], ["A", "A"], ["A", "gone"]):
        with pytest.raises(ValueError):
            B.scoped(df, symbols, ["1h"])


def test_fingerprint_ignores_order(bars):
    df, _ = bars
    key = lambda d: sorted(map(tuple, B.fingerprint(d).collect()))
    assert key(df) == key(df.orderBy("close"))


def test_timeframes_from_one_scan(spark):
    """Nine timeframes are those of the ticks each, and read the ticks once."""
    got = B.event_timeframes(spark, SMALL)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan
    for t in ("5m", "3h", "1day"):
        key = lambda d: sorted(map(tuple, d.collect()))
        assert key(got.where(F.col("timeframe") == t)) == key(B.event_bars(spark, SMALL, t))
    assert B.event_timeframes(spark, SMALL, ["2h"]).select("timeframe").distinct().count() == 1


def test_recursions_by_hand_stand_alone():
    """Every recursive column has SQL that knows nothing of the graph."""
    from barloom.plans import formulas_recursive

    assert set(formulas_recursive.BY_HAND) == {k for k, e in R.every().items() if e.scan}
    source = open(formulas_recursive.__file__).read()
    assert "functions" not in source.split("from __future__")[1] and "operators" not in source


def test_many_sequences_in_one_call(spark):
    """Kernels of many sequences are those of each, bit for bit: short, long, with gaps, without a name, longer than a call."""
    frames = [made(n, i, f"s{i % 40:02}", start, flat=range(min(71, n), min(99, n)) if i % 3 == 0 else (), quiet=[0] if i % 4 == 0 else ()).assign(timeframe=f"{i // 40}h") for i, (n, start) in enumerate([(r, "2019-12-01") for r in (300, 1, 2, 40, 120, 7) * 10])]
    frames[5].loc[[0, 3], ["close", "volume"]] = None
    frames[12].loc[[0, 150], ["close", "high"]] = None
    frames.append(made(30, 99).assign(symbol=None))
    df, wanted = spark.createDataFrame(pd.concat(frames), SCHEMA), R.every()
    for together in (60_000, 100):
        got = abreast(df, wanted, together=together).toPandas().fillna({"symbol": "none"})
        assert list(got.columns) == ["symbol", "timeframe", "trade_time", *wanted] and len(got) == sum(map(len, frames))
        sequences = {k: v.sort_values("trade_time") for k, v in got.groupby(["symbol", "timeframe"])}
        for f in frames:
            want = evaluate(wanted.values(), {c: f[c].to_numpy(float) for c in NUMBERS})
            own = sequences[f.symbol[0] or "none", f.timeframe[0]]
            for column, values in zip(wanted, want, strict=True):
                np.testing.assert_array_equal(own[column].to_numpy(float), values, err_msg=column)


def test_suppliers_have_no_frames_in_the_plan(spark):
    """All columns of suppliers come from one step, without a window."""
    from barloom.plans.queries import features_suppliers

    plan = features_suppliers(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Window ") == 0 and plan.count("MapInArrow kernel") == 1 and "FlatMapGroupsInArrow" not in plan


def test_suppliers_are_dealt_once(spark):
    """Lines are shuffled once, without text, and bars not again; they are those of the aggregation, without keyless lines."""
    from barloom.plans.queries import features_suppliers

    plan = features_suppliers(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.split("Exchange")[1].startswith(" hashpartitioning(l_suppkey")
    assert plan.count("+- Sort [") == 1


def test_lines_of_a_task_are_bounded(spark, monkeypatch):
    """Where the session has too few partitions, there are as many as the lines need; results stay the same, also with clocks that go back."""
    key = lambda d: sorted(map(tuple, d.collect()), key=repr)
    wanted = ["excel_EXPMA_12", "excel_WMA_20"]
    made = lambda dealt: compute(B.lineitem_bars(spark, SMALL, "l_suppkey", dealt=dealt), columns=wanted, kernels=True, dealt=dealt)
    want = key(made(False))
    monkeypatch.setattr(B, "LINES", 500)
    assert made(True)._jdf.queryExecution().executedPlan().toString().count(", 12), REPARTITION_BY_NUM") == 1
    assert key(made(True)) == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert key(made(True)) == key(made(False)) and made(True).schema == made(False).schema
        assert made(True)._jdf.queryExecution().executedPlan().toString().count("+- Sort [") == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dealt_bars_are_those_of_the_aggregation(spark, tmp_path):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    odd = lines.orderBy("l_orderkey", "l_linenumber", "l_partkey").limit(40)
    odd = odd.withColumn("l_suppkey", F.expr("CASE WHEN l_linenumber > 3 THEN l_suppkey END")).unionByName(odd.withColumn("l_shipdate", F.expr("CAST(NULL AS TIMESTAMP_NTZ)"))).unionByName(odd.withColumn("l_extendedprice", F.expr("CAST(NULL AS DOUBLE)")))
    many = lines.where("l_suppkey < 3").withColumn("l_partkey", F.expr("l_partkey + 100000"))
    lines.unionByName(odd).unionByName(many).repartition(7).write.parquet(f"{tmp_path}/lineitem.parquet")
    want, got = (B.lineitem_bars(spark, str(tmp_path), "l_suppkey", dealt=x) for x in (False, True))
    assert got.schema == want.schema
    key = lambda d: sorted(map(tuple, d.collect()), key=repr)
    assert key(got) == key(want)
    wanted = ["excel_EXPMA_12", "excel_WMA_20", "excel_OSC_40"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = got.select("symbol", F.spark_partition_id().alias("place")).distinct().collect()
        assert len({r.symbol for r in places}) == len(places) and len({r.place for r in places}) > 1
        assert key(compute(got, columns=wanted, kernels=True, dealt=True)) == key(compute(want, columns=wanted, kernels=True))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_users_have_no_frames_in_the_plan(spark):
    """All columns of users come from one step; the only window is the open interest."""
    from barloom.plans.queries import features_users

    plan = features_users(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Window ") == 1 and plan.count("MapInArrow kernel") == 1


def test_cut_is_the_sql_of_the_other_engine(spark):
    from barloom.plans.queries import cut, quantised

    r = np.random.default_rng(53)
    x = np.concatenate([r.normal(size=500) * 10.0 ** r.integers(-8, 19, 500), [0.0, -0.0, 1e4, -1e4, 1e9, 1e15, -1e15, 1e300, math.nextafter(1e4, 0), math.nextafter(1e9, 0), math.nextafter(1e15, 0), 0.5e-6]])
    got = [v for (v,) in spark.createDataFrame([(float(v),) for v in x], "x double").selectExpr(f"{quantised('x')} AS y").collect()]
    np.testing.assert_array_equal(cut(x), got)
    assert not np.signbit(cut(np.array([-0.0]))[0]) and np.isnan(cut(np.array([math.nan]))[0])
