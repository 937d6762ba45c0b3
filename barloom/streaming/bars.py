"""Bars from a stream of ticks, and features of bars as they close.

Ticks become bars by a windowed aggregation behind a watermark: a bar is given out once,
when no earlier tick can come.  Late ticks are dropped by the watermark, as the stream's
contract says.

Features need a sequence's past.  `stream_features` keeps it in the state store, per
sequence: of each frame the rows it still reaches, of each running sum and recursion its
state, under the signature of its formula.  That is bounded whatever the sequence's length,
and holds for all columns.  A stream may begin with the past of a history table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.states import step
from ..operators.registry import select
from ..session import ship
from ..plans.states import stream_pasts
from ..sources.bars import KEYS, NUMBERS, SCHEMA, TIME, TIMEFRAMES


def stream_bars(ticks: DataFrame, *, symbol: Column, time: str, price: Column, size: Column, order: Column, timeframe: str, late: str = "10 minutes") -> DataFrame:
    """Closed bars of a tick stream; open and close are by `order`, open interest is 0."""
    span = F.window(time, f"{TIMEFRAMES[timeframe]} minutes")
    rows = ticks.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(symbol.alias("symbol"), span)
    made = rows.agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum(size).cast("double").alias("volume"))
    return made.select("symbol", F.lit(timeframe).alias("timeframe"), F.col("window.start").alias(TIME), "open", "high", "low", "close", "volume", F.lit(0.0).alias("open_interest"))


class Following(StatefulProcessor):
    """Features of a sequence's bars as they come; keeps its last time and its past by signatures."""

    def __init__(self, columns: list[str]):
        self.columns, self.outputs = columns, select(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", T.StructType([T.StructField("last", T.LongType()), T.StructField("names", T.ArrayType(T.StringType())), T.StructField("numbers", T.ArrayType(T.ArrayType(T.DoubleType())))]))

    def handleInitialState(self, key: tuple, initial: pd.DataFrame, timers: object) -> None:
        row = initial.iloc[0]
        past = dict(row["past"])
        self.kept.update((int(row["last"]), list(past), [[float(v) for v in x] for x in past.values()]))

    def handleInputRows(self, key: tuple, frames: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        last, past = np.iinfo(np.int64).min, None
        if self.kept.exists():
            last, names, numbers = self.kept.get()
            past = {n: list(x) for n, x in zip(names, numbers, strict=True)}
        new = pd.concat(list(frames)).sort_values(TIME).drop_duplicates(TIME)
        when = new[TIME].to_numpy("datetime64[us]").astype(np.int64)
        new = new[when > last]
        if len(new):
            got, past = step(self.outputs, {c: new[c].to_numpy(float) for c in NUMBERS}, past)
            self.kept.update((int(when[-1]), list(past), list(past.values())))
            yield pd.DataFrame({"symbol": key[0], "timeframe": key[1], TIME: new[TIME].to_numpy()} | dict(zip(self.columns, got, strict=True)))

    def close(self) -> None:
        pass


def stream_features(bars: DataFrame, columns: list[str], history: DataFrame | None = None) -> DataFrame:
    """The columns for every bar of a stream, in append mode.

    Bars of a sequence must come in time order from batch to batch (those of
    `stream_bars` do); inside a batch they are sorted.  A bar not later than the last
    one seen is a repetition and is dropped, so a batch that is replayed does no harm.
    history: bars before the stream's; their past is the state that a new query begins with,
    so that its first bars are warmed up.  Without it a sequence begins with its first bar.

    A query that is started again from its checkpoint may ask for fewer columns.  One that
    asks for a column whose past was not kept fails and names it: begin a new query, with
    history.  The state store must be RocksDB; the session is told so.
    """
    spark = ship(bars.sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out = T.StructType([*SCHEMA.fields[:3], *(T.StructField(c, T.DoubleType()) for c in columns)])
    initial = stream_pasts(history, columns).groupBy(*KEYS) if history is not None else None
    rows = bars.select(*[f.name for f in SCHEMA]).groupBy(*KEYS)
    return rows.transformWithStateInPandas(Following(columns), out, "Append", "None", initial)
