"""Streams against the same work in batch."""

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from barloom.operators.registry import family
from barloom.plans.features import compute
from barloom.sources.bars import SCHEMA
from barloom.streaming.bars import stream_bars, stream_features
from tests.conftest import SMALL
from tests.test_features import made

COLUMNS = ["tv_sma_10", "wh6_MA_MA1", "tv_wma_21", "excel_CLV", "indicator_py_ret_5", "tv_stoch_d_3", "tv_obv", "tv_ema_8", "wh6_MACD_MACD", "excel_OSC_40", *(c for c, e in family("tv").items() if e.scan)]
COLUMNS = list(dict.fromkeys(COLUMNS))


def test_features_batch_by_batch(spark, tmp_path):
    f = pd.concat([made(90, 1, "a"), made(70, 2, "b")]).sort_values("trade_time")
    folder = str(tmp_path / "in")
    for i in range(0, len(f), 40):
        part = f[i : i + 40]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame(f[:5], SCHEMA).coalesce(1).write.mode("append").parquet(folder)  # a repetition
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    q = stream_features(stream, COLUMNS).writeStream.format("memory").queryName("streamed").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("streamed").orderBy("symbol", "trade_time").toPandas()
    want = compute(spark.createDataFrame(f, SCHEMA), columns=COLUMNS).orderBy("symbol", "trade_time").toPandas()
    pd.testing.assert_frame_equal(got, want, rtol=1e-9, check_dtype=False)


def follow(spark, folder, checkpoint, columns, name, history=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    out = stream_features(stream, columns, history).writeStream.foreachBatch(lambda df, i: df.write.mode("append").parquet(name)).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    out.start().awaitTermination()
    return spark.read.parquet(name).orderBy("symbol", "trade_time").toPandas()


def test_a_stream_that_begins_with_history(spark, tmp_path):
    """Its first bars are warmed up: all values are those of history and stream in one batch."""
    f = pd.concat([made(150, 1, "a"), made(120, 2, "b")]).sort_values("trade_time")
    new = f[f.trade_time >= "2019-12-04"]
    only = made(30, 3, "c", start="2019-12-05")  # has no history
    folder = str(tmp_path / "in")
    live = pd.concat([new, only]).sort_values("trade_time")
    for i in range(0, len(live), 60):
        spark.createDataFrame(live[i : i + 60], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    got = follow(spark, folder, str(tmp_path / "cp"), COLUMNS, str(tmp_path / "out"), spark.createDataFrame(f[f.trade_time < "2019-12-04"], SCHEMA))
    want = compute(spark.createDataFrame(pd.concat([f, only]), SCHEMA), columns=COLUMNS).join(spark.createDataFrame(live, SCHEMA).select("symbol", "trade_time"), ["symbol", "trade_time"]).orderBy("symbol", "trade_time").toPandas()[got.columns]
    assert len(got) == len(live)
    pd.testing.assert_frame_equal(got, want, rtol=1e-9, check_dtype=False)


def test_a_query_started_again_with_other_columns(spark, tmp_path):
    """Fewer columns, in another order, go on; a column whose past was not kept is refused by name."""
    f = made(120, 4, "a")
    folder, checkpoint, out = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "out")
    put = lambda part: spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    put(f[:70])
    follow(spark, folder, checkpoint, ["tv_ema_21", "tv_sma_10", "tv_obv", "tv_psar_dir"], out)
    put(f[70:])
    fewer = ["tv_psar_dir", "tv_ema_21"]
    got = follow(spark, folder, checkpoint, fewer, str(tmp_path / "second"))
    want = compute(spark.createDataFrame(f, SCHEMA), columns=fewer).orderBy("trade_time").toPandas()[70:].reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, rtol=1e-9, check_dtype=False)
    put(made(5, 5, "a", start="2020-01-01"))
    with pytest.raises(StreamingQueryException, match="no past was kept for tv_rsi_14"):
        follow(spark, folder, checkpoint, ["tv_ema_21", "tv_rsi_14"], str(tmp_path / "third"))


def test_bars_close_once(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(SMALL, pathGlobFilter="events.parquet")
    ticks = {"symbol": F.col("event_type"), "time": "ts", "price": F.col("value"), "size": F.lit(1.0), "order": F.struct("ts", "event_id"), "timeframe": "1h"}
    q = stream_bars(stream, **ticks).writeStream.format("memory").queryName("bars").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("bars")
    span = F.window("ts", "60 minutes")
    want = events.groupBy(F.col("event_type").alias("symbol"), span).agg(F.max("value").alias("high"), F.count("*").cast("double").alias("volume")).select("symbol", F.col("window.start").alias("trade_time"), "high", "volume")
    pairs = got.join(want, ["symbol", "trade_time"]).where((got.high == want.high) & (got.volume == want.volume))
    assert got.count() > 0 and pairs.count() == got.count() == got.select("symbol", "trade_time").distinct().count()
    assert want.count() - got.count() <= 10  # what the watermark still holds open
