"""Features of new bars that start from a kept past."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.expr import C, ema, lag
from barloom.functions.states import MissingState, signature, step
from barloom.operators import registry as R
from barloom.plans.features import compute
from barloom.plans.states import advance
from barloom.sources.bars import SCHEMA
from tests.test_features import made


def test_signatures_name_formulas():
    assert signature(ema(C, 5) - lag(C, 3)) == signature(ema(C, 5) - lag(C, 3)) != signature(ema(C, 5) - lag(C, 2))
    assert len({signature(e) for e in R.every().values()}) == len(set(R.every().values()))


def test_other_columns_need_a_past():
    bars = {c: made(30)[c].to_numpy(float) for c in ("open", "high", "low", "close", "volume", "open_interest")}
    _, kept = step(R.select(["tv_ema_8", "tv_sma_10"]), bars, None)
    step(R.select(["tv_sma_10"]), bars, kept)
    with pytest.raises(MissingState, match="tv_rsi_14"):
        step(R.select(["tv_sma_10", "tv_rsi_14"]), bars, kept)


def test_day_after_day_equals_the_whole(spark, tmp_path):
    """All columns, three appended days, a sequence that pauses and one that begins later: the same bytes as at once."""
    frames = [made(330, 1, "a", flat=range(171, 199), quiet=[0, 83, 84, 219]), made(300, 2, "A"), made(40, 3, "late", start="2019-12-12")]
    f = pd.concat(frames)
    f = f[~((f.symbol == "A") & (f.trade_time >= "2019-12-12") & (f.trade_time < "2019-12-13"))]
    df = spark.createDataFrame(f, SCHEMA)
    whole = compute(df).cache()
    pasts, got = None, []
    for i, (begin, end) in enumerate([("2019-12-01", "2019-12-12"), ("2019-12-12", "2019-12-13"), ("2019-12-13", "2020-01-01")]):
        features, after = advance(df.where(f"trade_time >= '{begin}' AND trade_time < '{end}'"), pasts)
        features.write.parquet(str(tmp_path / f"f{i}"))
        after.write.parquet(str(tmp_path / f"s{i}"))
        pasts = spark.read.schema(after.schema).parquet(str(tmp_path / f"s{i}"))
        got.append(spark.read.schema(features.schema).parquet(str(tmp_path / f"f{i}")))
    every = got[0].unionByName(got[1]).unionByName(got[2])
    columns = [c for c in whole.columns if c not in ("symbol", "timeframe", "trade_time")]
    both = every.alias("x").join(whole.alias("y"), ["symbol", "timeframe", "trade_time"])
    assert every.count() == whole.count() == both.count() == len(f)
    differ = both.agg(*[F.sum((~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))).cast("int")).alias(c) for c in columns]).first().asDict()
    assert {c: n for c, n in differ.items() if n} == {}
    assert pasts.select(F.max(F.size("tail"))).first()[0] < 330
    late = df.where("symbol = 'a' AND trade_time < '2019-12-02'")
    with pytest.raises(Exception, match="not later than its past"):
        advance(late, pasts, columns=["tv_ema_8"])[0].count()
