"""Bars: their schema, checks, and their construction from trades and events.

A bar is (symbol, timeframe, trade_time, open, high, low, close, volume, open_interest).
A sequence is all bars of a symbol and timeframe in the order of trade_time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS, TIME = ("symbol", "timeframe"), "trade_time"
PRICES = ("open", "high", "low", "close")
NUMBERS = (*PRICES, "volume", "open_interest")
SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("timeframe", T.StringType()), T.StructField(TIME, T.TimestampType()), *(T.StructField(c, T.DoubleType()) for c in NUMBERS)])
# The timeframes in order, with their minutes.
TIMEFRAMES = {"5m": 5, "10m": 10, "15m": 15, "30m": 30, "1h": 60, "2h": 120, "3h": 180, "4h": 240, "1day": 1440}

#: Lines that a task sorts, where they are dealt before they are bars.
LINES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def resample(ticks: DataFrame, *, symbol: Column, bucket: Column, timeframe: str, price: Column, size: Column, order: Column, position: Column) -> DataFrame:
    """Ticks to bars by one aggregation with partial sums at the source.

    `order` must be unique inside a bar, or open and close are not determined; position
    is what a tick adds to the open interest.
    """
    grouped = ticks.where(symbol.isNotNull() & bucket.isNotNull()).groupBy(symbol.alias("symbol"), bucket.alias(TIME))
    return grouped.agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"),
        F.sum(size).cast("double").alias("volume"), F.sum(position).cast("double").alias("change"),
    ).withColumn("timeframe", F.lit(timeframe))


def with_open_interest(bars: DataFrame) -> DataFrame:
    """The running sum of the bars' changes; it stands on the same partitions as the features."""
    running = "sum(change) OVER (PARTITION BY symbol, timeframe ORDER BY trade_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return bars.selectExpr(*KEYS, TIME, *PRICES, "volume", f"{running} AS open_interest")


def lineitem_bars(spark: SparkSession, sf_dir: str, by: str = "l_returnflag", dealt: bool = False) -> DataFrame:
    """Daily bars of the line items by one of their columns; unit prices in the order of the line's keys.

    With dealt, for columns of about as many bars as lines, the lines are shuffled by that column before the aggregation, which has
    little to combine then, and bars stay where they are: those of a symbol in one partition and in order (`compute(dealt=True)`).
    The lines are counted first, from the files' footers, so that a task sorts `LINES` of them or little more, in memory.
    """
    ticks = table(spark, sf_dir, "lineitem")
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    price, size = F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_quantity")
    signed = F.when(F.col("l_linestatus") == "O", size).otherwise(-size)
    if not dealt:
        return with_open_interest(resample(ticks, symbol=F.col(by).cast("string"), bucket=F.col("l_shipdate"), timeframe="1day", price=price, size=size, order=F.struct(*keys), position=signed))
    n = ticks.count() // LINES
    ticks = ticks.where(F.col(by).isNotNull() & F.col("l_shipdate").isNotNull())
    ticks = ticks.select(*dict.fromkeys([by, *keys]), "l_shipdate", price.alias("price"), size.alias("size"), signed.alias("position"))
    # More partitions than the session has are told; fewer are left to adaptive execution.
    ticks = ticks.repartition(n, by) if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else ticks.repartition(by)
    bars = resample(ticks, symbol=F.col(by), bucket=F.col("l_shipdate"), timeframe="1day", price=F.col("price"), size=F.col("size"), order=F.struct(*keys), position=F.col("position"))
    # The aggregation sorts by local time, so this sort costs nothing; where clocks go back, instants have another order.
    utc = spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")
    bars = bars.sortWithinPartitions("symbol", TIME if utc else F.col(TIME).cast("timestamp"))
    return with_open_interest(bars.withColumn("symbol", F.col("symbol").cast("string")))


def event_bars(spark: SparkSession, sf_dir: str, timeframe: str = "1h", by: str = "event_type") -> DataFrame:
    """Bars of the event values by one of their columns in tumbling windows."""
    ticks = table(spark, sf_dir, "events")
    start = F.window("ts", f"{TIMEFRAMES[timeframe]} minutes")["start"]
    return with_open_interest(resample(ticks, symbol=F.col(by).cast("string"), bucket=start, timeframe=timeframe, price=F.col("value"), size=F.lit(1.0), order=F.struct("ts", "event_id"), position=F.sign("value")))


def resample_all(ticks: DataFrame, *, symbol: Column, time: Column, timeframes: Sequence[str], price: Column, size: Column, order: Column, position: Column) -> DataFrame:
    """Bars of several timeframes from one scan: ticks become bars of the finest common step, and these the rest.

    Bars merge: a first or last price travels with its order, the rest are sums and
    extremes.  Both aggregations combine at the source, so what is shuffled are bars of the
    finest step, and then at most one row for each wanted bar and task.
    """
    minutes = math.gcd(*(TIMEFRAMES[t] for t in timeframes))
    start = lambda when, n: F.timestamp_seconds(F.floor(F.unix_micros(when.cast("timestamp")) / (n * 60_000_000)) * (n * 60))
    priced = F.struct(order.alias("order"), price.alias("price"))
    fine = ticks.where(symbol.isNotNull() & time.isNotNull()).groupBy(symbol.alias("symbol"), start(time, minutes).alias("step")).agg(
        F.min(F.when(price.isNotNull(), priced)).alias("first"), F.max(F.when(price.isNotNull(), priced)).alias("last"), F.max(price).alias("high"), F.min(price).alias("low"), F.sum(size).alias("volume"), F.sum(position).alias("change"),
    )
    bars = F.array(*[F.struct(F.lit(t).alias("timeframe"), start(F.col("step"), TIMEFRAMES[t]).alias(TIME)) for t in timeframes])
    merged = fine.withColumn("bar", F.explode(bars)).groupBy("symbol", "bar.timeframe", f"bar.{TIME}").agg(
        F.min("first").alias("first"), F.max("high").alias("high"), F.min("low").alias("low"), F.max("last").alias("last"), F.sum("volume").cast("double").alias("volume"), F.sum("change").cast("double").alias("change"),
    )
    return merged.select(*KEYS, TIME, F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume", "change")


def event_timeframes(spark: SparkSession, sf_dir: str, timeframes: Sequence[str] = tuple(TIMEFRAMES), by: str = "event_type") -> DataFrame:
    """Bars of the event values in several timeframes, from one scan of the events."""
    return with_open_interest(resample_all(table(spark, sf_dir, "events"), symbol=F.col(by).cast("string"), time=F.col("ts"), timeframes=timeframes, price=F.col("value"), size=F.lit(1.0), order=F.struct("ts", "event_id"), position=F.sign("value")))


def lineitem_sql(by: str = "l_returnflag") -> str:
    return f"""
SELECT symbol, timeframe, trade_time, open, high, low, close, volume,
  sum(change) OVER (PARTITION BY symbol, timeframe ORDER BY trade_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_interest
FROM (SELECT {by}::VARCHAR AS symbol, '1day' AS timeframe, l_shipdate AS trade_time,
    arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS open, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
    arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS close, sum(l_quantity) AS volume,
    sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END) AS change
  FROM lineitem GROUP BY 1, 2, 3)
"""


LINEITEM_SQL = lineitem_sql()


def events_sql(timeframe: str = "1h", by: str = "event_type") -> str:
    bucket = f"time_bucket(INTERVAL '{TIMEFRAMES[timeframe]} minutes', ts, TIMESTAMP '1970-01-01')"
    return f"""
SELECT symbol, timeframe, trade_time, open, high, low, close, volume,
  sum(change) OVER (PARTITION BY symbol, timeframe ORDER BY trade_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_interest
FROM (SELECT {by}::VARCHAR AS symbol, '{timeframe}' AS timeframe, {bucket} AS trade_time, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, (ts, event_id)) AS close, count(*)::DOUBLE AS volume, sum(sign(value))::DOUBLE AS change
  FROM events GROUP BY 1, 2, 3)
"""


def rebase(bars: DataFrame) -> DataFrame:
    """Bars with exactly the columns and types of SCHEMA; a missing column is an error."""
    missing = [f.name for f in SCHEMA if f.name not in bars.columns]
    if missing:
        raise ValueError(f"bars lack {missing}")
    return bars.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA])


def violations(bars: DataFrame) -> DataFrame:
    """One row for each sequence with the counts of broken rules; all zero is valid.

    One window and one aggregation over the same partitions: time must rise strictly,
    numbers must be finite, and where they are, high and low must enclose open and close.
    """
    before = "lag(trade_time) OVER (PARTITION BY symbol, timeframe ORDER BY trade_time)"
    bad = " OR ".join(f"{c} IS NULL OR isnan({c}) OR abs({c}) = CAST('Infinity' AS DOUBLE)" for c in NUMBERS)
    rows = bars.selectExpr(*KEYS, TIME, f"CASE WHEN trade_time <= {before} THEN 1 ELSE 0 END AS unordered", f"CASE WHEN {bad} THEN 1 ELSE 0 END AS unfit", f"CASE WHEN NOT coalesce({bad}, true) AND (high < greatest(open, close) OR low > least(open, close)) THEN 1 ELSE 0 END AS outside", "CASE WHEN volume < 0 THEN 1 ELSE 0 END AS negative")
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n_bars"), F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"), *[F.sum(c).cast("long").alias(c) for c in ("unordered", "unfit", "outside", "negative")])


def latest(history: DataFrame, version: str) -> DataFrame:
    """Of rows with the same key the one with the highest version."""
    order = f"row_number() OVER (PARTITION BY symbol, timeframe, trade_time ORDER BY {version} DESC)"
    return history.withColumn("__n", F.expr(order)).where("__n = 1").drop("__n")


def fingerprint(bars: DataFrame) -> DataFrame:
    """Rows, first and last time, and an order-free hash of each sequence."""
    h = F.xxhash64(*[F.col(c) for c in (*KEYS, TIME, *NUMBERS)])
    return bars.groupBy(*KEYS).agg(F.count("*").alias("n_bars"), F.min(TIME).alias("first_time"), F.max(TIME).alias("last_time"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def scoped(bars: DataFrame, symbols: list[str] | None = None, timeframes: list[str] | None = None) -> DataFrame:
    """Only the named symbols and timeframes, which must be distinct and all there."""
    out = bars
    for name, wanted in (("symbol", symbols), ("timeframe", timeframes)):
        if wanted is not None:
            if not wanted or len(set(wanted)) != len(wanted):
                raise ValueError(f"{name}s must be distinct and not none")
            out = out.where(F.col(name).isin(*wanted))
    if symbols and timeframes:
        found = out.select(*KEYS).distinct().count()
        if found != len(symbols) * len(timeframes):
            raise ValueError(f"{found} of {len(symbols) * len(timeframes)} sequences are there")
    return out


def one_sequence(bars: DataFrame, identity: tuple[str, ...] = ("symbol", "timeframe", "period", "contract_code")) -> DataFrame:
    """bars, which must be one sequence: each identity column that is there has one value, and no null."""
    there = [c for c in identity if c in bars.columns]
    row = bars.agg(F.count("*"), *[x for c in there for x in (F.min(c), F.max(c), F.count(c))]).first()
    for i, c in enumerate(there):
        least, most, n = row[3 * i + 1 : 3 * i + 4]
        if least != most or n != row[0]:
            raise ValueError(f"{c} has more than one value, or none")
    return bars
