"""Registered queries of the feature engine, with SQL for a second engine where it has words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.registry import FAMILIES, family
from ..session import ship
from ..sources import bars as B
from . import audit, formulas, formulas_recursive
from .carried import rounds
from .features import compute, live_only, sql_text, windows
from .preflight import exactly_one, preflight

BOUNDARY = "1997-01-01"


def quantised(x: str) -> str:
    """Cut to a grid so that engines that sum in another order agree; text for either.

    The grid's steps lie off the halves, where means of decimal prices often fall.  Of
    very large values the logarithm is cut.
    """
    k = "0.381966011e0"
    large = f"WHEN abs({x}) >= 1e15 THEN sign({x}) * floor(ln(abs({x})) * 1e6 + {k}) / 1e6"
    return f"(CASE {large} WHEN abs({x}) < 1e4 THEN floor({x} * 1e6 + {k}) / 1e6 WHEN abs({x}) < 1e9 THEN floor({x} * 1e2 + {k}) / 1e2 ELSE floor({x} / 1e4 + {k}) * 1e4 END + 0e0)"


def cut(x: np.ndarray) -> np.ndarray:
    """`quantised` for kernels: as SQL over some 60 columns it took longer than they do."""
    k, size = 0.381966011, np.abs(x)
    out = np.floor(x * 1e6 + k) / 1e6
    for least, to in ((1e4, lambda v: np.floor(v * 1e2 + k) / 1e2), (1e9, lambda v: np.floor(v / 1e4 + k) * 1e4), (1e15, lambda v: np.sign(v) * np.floor(np.log(np.abs(v)) * 1e6 + k) / 1e6)):
        if len(at := np.flatnonzero(size >= least)):
            out[at] = to(x[at])
    return out + 0.0


def rounded(df: DataFrame) -> DataFrame:
    kept = (*B.KEYS, B.TIME)
    return df.select(*kept, *[F.expr(quantised(c)).alias(c) for c in df.columns if c not in kept])


def plain(name: str) -> list[str]:
    return [k for k, e in family(name).items() if not e.scan]


def recursive(name: str) -> list[str]:
    return [k for k, e in family(name).items() if e.scan]


def bars_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(B.lineitem_bars(spark, sf_dir))


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(B.event_bars(spark, sf_dir))


def bars_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.violations(B.lineitem_bars(spark, sf_dir))


def bars_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each type and hour, by row_number over the key."""
    ticks = B.table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.lit("1h").alias("timeframe"), F.date_trunc("hour", "ts").alias("trade_time"), "event_id", "value")
    return B.latest(ticks, "event_id")


def _plain_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(compute(B.lineitem_bars(spark, sf_dir), columns=plain(name)))


def _event_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(compute(B.event_bars(spark, sf_dir), columns=plain(name)))


def _recursive_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(compute(B.lineitem_bars(spark, sf_dir), columns=recursive(name)))


def features_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 465 columns of every daily bar."""
    return rounded(compute(B.lineitem_bars(spark, sf_dir)))


def features_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages, channels, bands and MACD of daily bars after the boundary, warmed up before it."""
    columns = ["wh6_MA_MA1", "wh6_u_a4f8ae15_UPPER", "wh6_u_a4f8ae15_LOWER", "wh6_u_a4f8ae15_MIDDLE", "wh6_BOLL_MID", "wh6_BOLL_TOP", "wh6_BOLL_BOTTOM", "wh6_MACD_DIFF", "wh6_MACD_DEA", "wh6_MACD_MACD"]
    bars = B.lineitem_bars(spark, sf_dir)
    return rounded(live_only(bars, bars.where(F.col(B.TIME) >= F.to_timestamp(F.lit(BOUNDARY))), start=BOUNDARY, columns=columns))


def features_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The excel family's windows, warm history cut off behind them."""
    bars = B.lineitem_bars(spark, sf_dir)
    return rounded(live_only(bars, bars.where(F.col(B.TIME) >= F.to_timestamp(F.lit(BOUNDARY))), start=BOUNDARY, columns=plain("excel")))


def audit_warmup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of live bars with history against the same windows from a cold start."""
    ship(spark)
    bars = B.lineitem_bars(spark, sf_dir)
    live = bars.where(F.col(B.TIME) >= F.to_timestamp(F.lit(BOUNDARY)))
    columns = ["tv_obv", "tv_sma_50", "wh6_MA_MA1", "excel_CLV", "indicator_py_ret_1"]
    report = audit.compare(live_only(bars, live, start=BOUNDARY, columns=columns), compute(live, columns=columns))
    return report.select("column", "n_cells", "null_mismatches", "missing", "status")


def audit_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of whole days against bars of those days that have a return."""
    bars = B.lineitem_bars(spark, sf_dir)
    return audit.coverage(bars, bars.where("volume > 100"))


def _by_hand(name: str) -> list[str]:
    return [c for c in family(name) if c in formulas.BY_HAND]


def _formula_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Columns of the family whose SQL is written by hand."""
    return lambda spark, sf_dir: rounded(compute(B.lineitem_bars(spark, sf_dir), columns=_by_hand(name)))


def _silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of which every seventh day is silent and every fifth flat, by their dates."""
    day = F.datediff(B.TIME, F.lit("1970-01-01"))
    quiet, flat = day % 7 == 0, day % 5 == 0
    prices = {c: F.when(flat, F.col("close")).otherwise(F.col(c)) for c in ("open", "high", "low")}
    return B.lineitem_bars(spark, sf_dir).withColumns({**prices, "volume": F.when(quiet, F.lit(0.0)).otherwise(F.col("volume").cast("double"))})


_DAY = "date_diff('day', DATE '1970-01-01', trade_time::DATE)"
SILENT_SQL = f"SELECT symbol, timeframe, trade_time, {', '.join(f'CASE WHEN {_DAY} % 5 = 0 THEN close ELSE {c} END AS {c}' for c in ('open', 'high', 'low'))}, close, CASE WHEN {_DAY} % 7 = 0 THEN 0e0 ELSE volume::DOUBLE END AS volume, open_interest FROM ({B.LINEITEM_SQL})"


def formulas_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns whose SQL is written by hand, over bars with silent and flat days."""
    return rounded(compute(_silent(spark, sf_dir), columns=list(formulas.BY_HAND)))


def features_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The excel family, windows and recursions, of a sequence for each supplier."""
    return compute(B.lineitem_bars(spark, sf_dir, "l_suppkey", dealt=True), families=("excel",), kernels=True, finish=cut, dealt=True)


USER_TIMEFRAMES = ("1h", "4h", "1day")


def features_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the indicator family for each user's bars in three timeframes."""
    return compute(B.event_timeframes(spark, sf_dir, USER_TIMEFRAMES, "user_id"), columns=plain("indicator"), kernels=True, finish=cut)


def bars_timeframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the events in all nine timeframes, from one scan."""
    return rounded(B.event_timeframes(spark, sf_dir))


PART_ROWS = 1_000


def features_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the tv family over five-minute bars, each long sequence in parts of days."""
    bars = B.event_bars(spark, sf_dir, "5m")
    return rounded(compute(bars, columns=plain("tv"), split=PART_ROWS))


def stateful(name: str) -> list[str]:
    return [k for k, e in family(name).items() if rounds([e])]


def recursions_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursions and running columns of the tv family over five-minute bars, by parts of sequences."""
    return rounded(compute(B.event_bars(spark, sf_dir, "5m"), columns=stateful("tv"), split=PART_ROWS))


#: Recursive columns of each family whose start is felt long after it.
SLOW = {
    "wh6": ("wh6_MACD_DIFF", "wh6_MACD_DEA"), "indicator": ("indicator_py_macd_diff", "indicator_py_ppo"), "excel": ("excel_EXPMA_50", "excel_TEMA_40", "excel_RSIH_40_120"), "tv": ("tv_ema_55", "tv_rsi_21", "tv_atr_14", "tv_tsi_25_13"),
}
AUDITED = ("column", "n_cells", "null_mismatches", "infinities", "beyond", "max_abs", "max_rel", "p99_abs", "p99_rel", "missing", "status")


def slow(name: str) -> list[str]:
    """Columns of the family for `audit_start_*`: those of SLOW that there are, and its first recursions."""
    found = [c for c in SLOW[name] if c in family(name)]
    return found + [c for c in recursive(name) if c not in found][: 6 - len(found)]


def _start_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """How far recursions that begin at the boundary are from those with history: exact maxima and p99."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = B.lineitem_bars(ship(spark), sf_dir)
        live = bars.where(F.col(B.TIME) >= F.to_timestamp(F.lit(BOUNDARY)))
        report = audit.compare(live_only(bars, live, start=BOUNDARY, columns=slow(name)), compute(live, columns=slow(name)))
        return report.select(*[F.expr(quantised(c)).alias(c) if c[:3] in ("max", "p99") else F.col(c) for c in AUDITED])

    return query


def _start_sql(name: str) -> str:
    live = f"SELECT * FROM ({B.LINEITEM_SQL}) WHERE trade_time >= TIMESTAMP '{BOUNDARY}'"
    one = """SELECT '{c}' AS "column", count(*) AS n_cells, count(*) FILTER ((w.{c} IS NULL) <> (k.{c} IS NULL)) AS null_mismatches, 0::BIGINT AS infinities, count(*) FILTER (abs(w.{c} - k.{c}) > greatest(1e-6, abs(w.{c}) * 1e-9)) AS beyond,
  max(abs(w.{c} - k.{c})) AS max_abs, max(abs(w.{c} - k.{c}) / nullif(abs(w.{c}), 0)) AS max_rel, quantile_cont(abs(w.{c} - k.{c}), 0.99) AS p99_abs, quantile_cont(abs(w.{c} - k.{c}) / nullif(abs(w.{c}), 0), 0.99) AS p99_rel FROM w JOIN k USING (symbol, timeframe, trade_time)"""
    parts = " UNION ALL ".join(one.format(c=c) for c in slow(name))
    status = "CASE WHEN null_mismatches + beyond > 0 THEN 'FAIL' ELSE 'PASS' END"
    sums = ", ".join(f"{quantised(c)} AS {c}" for c in AUDITED if c[:3] in ("max", "p99"))
    return f"""WITH w AS MATERIALIZED ({sql_text(B.LINEITEM_SQL, slow(name))}), k AS MATERIALIZED ({sql_text(live, slow(name))}), r AS ({parts})
SELECT "column", n_cells, null_mismatches, infinities, beyond, {sums}, 0::BIGINT AS missing, {status} AS status FROM r"""


def bars_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a resumed build compares: rows and span of each sequence."""
    return B.fingerprint(B.lineitem_bars(spark, sf_dir, "l_suppkey")).select(*B.KEYS, "n_bars", "first_time", "last_time")


def audit_excel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of a family, stored from a warm start, against an audit that knows only the live bars."""
    bars = B.lineitem_bars(spark, sf_dir)
    live = bars.where(F.col(B.TIME) >= F.to_timestamp(F.lit(BOUNDARY)))
    warm = live_only(bars, live, start=BOUNDARY, columns=plain("excel"))
    report = audit.audit_features(live.join(warm, [*B.KEYS, B.TIME]), family="excel")
    return report.select("column", "n_cells", "null_mismatches", "infinities", "beyond", "missing", "status")


def _audit_sql(name: str) -> str:
    """Windows of the family with history and without; its recursions are not stored, so they fail without a cell."""
    live = f"SELECT * FROM ({B.LINEITEM_SQL}) WHERE trade_time >= TIMESTAMP '{BOUNDARY}'"
    one = """SELECT '{c}' AS "column", count(*) AS n_cells, count(*) FILTER ((w.{c} IS NULL) <> (k.{c} IS NULL)) AS null_mismatches, count(*) FILTER (abs(w.{c} - k.{c}) > greatest(1e-6, abs(w.{c}) * 1e-9)) AS beyond FROM w JOIN k USING (symbol, timeframe, trade_time)"""
    parts = [one.format(c=c) for c in plain(name)] + [f"SELECT '{c}', 0, 0, 0" for c in recursive(name)]
    return f"""WITH w AS MATERIALIZED ({sql_text(B.LINEITEM_SQL, plain(name))}), k AS MATERIALIZED ({sql_text(live, plain(name))}), r AS ({" UNION ALL ".join(parts)})
SELECT "column", n_cells::BIGINT AS n_cells, null_mismatches::BIGINT AS null_mismatches, 0::BIGINT AS infinities, beyond::BIGINT AS beyond, 0::BIGINT AS missing, CASE WHEN null_mismatches + beyond > 0 OR n_cells = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM r"""


def signals_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossings and rises of each supplier's daily closes."""
    signals = {
        "over_average": X.cross(X.avg(X.C, 5), X.avg(X.C, 20)), "under_average": X.cross(X.avg(X.C, 20), X.avg(X.C, 5)), "over_high": X.cross(X.C, X.lag(X.highest(X.H, 20))),
        "over_level": X.cross(X.C, 1500), "rising_1": X.rising(X.C, 1), "rising_10": X.rising(X.C, 10),
    }
    return windows(B.lineitem_bars(spark, sf_dir, "l_suppkey"), {k: X.number(e) for k, e in signals.items()}, [*B.KEYS, B.TIME])


SIGNALS_SQL = f"""
WITH a AS (SELECT *, lag(close) OVER w AS c1, lag(close, 10) OVER w AS c10, row_number() OVER w AS n, avg(close) OVER (w ROWS 4 PRECEDING) AS m5, avg(close) OVER (w ROWS 19 PRECEDING) AS m20, max(high) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS top
  FROM ({B.lineitem_sql("l_suppkey")}) WINDOW w AS (PARTITION BY symbol ORDER BY trade_time)),
b AS (SELECT *, lag(m5) OVER w AS p5, lag(m20) OVER w AS p20, lag(top) OVER w AS top1 FROM a WINDOW w AS (PARTITION BY symbol ORDER BY trade_time))
SELECT symbol, timeframe, trade_time, (n > 20 AND m5 > m20 AND p5 <= p20)::INT::DOUBLE AS over_average, (n > 20 AND m20 > m5 AND p20 <= p5)::INT::DOUBLE AS under_average, (n > 21 AND close > top AND c1 <= top1)::INT::DOUBLE AS over_high,
  coalesce(close > 1500 AND c1 <= 1500, false)::INT::DOUBLE AS over_level, coalesce(close > c1, false)::INT::DOUBLE AS rising_1, coalesce(close > c10, false)::INT::DOUBLE AS rising_10
FROM b
"""

PROFILE = tuple(str(i) for i in range(1, 121))


def preflight_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over the suppliers' daily bars, and trades of their first days, not yet bars, offered as history."""
    size = F.col("l_quantity")
    trades = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"), F.lit("1day").alias("timeframe"), F.col("l_shipdate").alias(B.TIME), *[(F.col("l_extendedprice") / size).alias(c) for c in B.PRICES],
        F.when(F.col("l_returnflag") == "R", -size).otherwise(size).alias("volume"), F.lit(0.0).alias("open_interest"),
    )
    return preflight(B.lineitem_bars(spark, sf_dir, "l_suppkey"), trades.where(F.col(B.TIME) < F.to_timestamp(F.lit("1992-02-20"))), start="1992-02-10", symbols=PROFILE, timeframes=("1day",))


_FINDING = "SELECT '{source}' AS source, symbol, timeframe, '{name}' AS finding, {n} AS n FROM {table}"
PREFLIGHT_SQL = f"""
WITH m AS MATERIALIZED (SELECT symbol, timeframe, count(*) - count(DISTINCT trade_time) AS repeated, 0 AS untimed, count(*) FILTER (high < greatest(open, close) OR low > least(open, close)) AS outside, count(*) FILTER (volume < 0) AS negative, count(*) FILTER (trade_time < TIMESTAMP '1992-02-10') AS misplaced FROM ({B.lineitem_sql("l_suppkey")}) GROUP BY ALL),
h AS MATERIALIZED (SELECT l_suppkey::VARCHAR AS symbol, '1day' AS timeframe, count(*) - count(DISTINCT l_shipdate) AS repeated, 0 AS untimed, 0 AS outside, count(*) FILTER (l_returnflag = 'R') AS negative, count(*) FILTER (l_shipdate >= TIMESTAMP '1992-02-10') AS misplaced FROM lineitem WHERE l_shipdate < TIMESTAMP '1992-02-20' AND l_suppkey::VARCHAR IN (SELECT symbol FROM m) GROUP BY ALL),
p AS (SELECT i::VARCHAR AS symbol, '1day' AS timeframe FROM range(1, 121) r(i)),
a AS (SELECT symbol, timeframe, m.repeated IS NOT NULL AS has, p.symbol IS NOT NULL AS wanted, h.repeated IS NOT NULL AS past FROM m FULL JOIN p USING (symbol, timeframe) LEFT JOIN h USING (symbol, timeframe)),
r AS ({" UNION ALL ".join([_FINDING.format(source=s, name=k, n=0 if k == "unfit" else k, table=t) for s, t in (("market", "m"), ("history", "h")) for k in ("repeated", "untimed", "unfit", "outside", "negative", "misplaced")]
  + [_FINDING.format(source="both", name=k, n=f"({x})::INT", table="a") for k, x in (("no_market", "wanted AND NOT has"), ("no_history", "has AND NOT past"), ("outside_profile", "has AND NOT wanted"))])})
SELECT source, symbol, timeframe, finding, n::BIGINT AS n, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM r
"""


def sequences_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's sequence with the one row that describes it."""
    suppliers = B.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"), F.lit("1day").alias("timeframe"), "s_name", "s_nationkey")
    counts = B.fingerprint(B.lineitem_bars(spark, sf_dir, "l_suppkey")).select(*B.KEYS, "n_bars")
    return exactly_one(counts, suppliers)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {f.__name__: f for f in (features_flagship, bars_lineitem, bars_events, bars_violations, bars_latest, bars_timeframes, features_all, features_live, audit_warmup, audit_coverage, features_suppliers, features_users, features_parts, recursions_parts, bars_fingerprint, audit_excel, signals_suppliers, preflight_suppliers, sequences_described)}
    for name in FAMILIES:
        named |= {f"features_{name}": _plain_query(name), f"features_{name}_events": _event_query(name), f"recursions_{name}": _recursive_query(name), f"formulas_{name}": _formula_query(name), f"audit_start_{name}": _start_query(name)}
    named["formulas_silent"] = formulas_silent
    return named


def _rounded_sql(source: str) -> str:
    return f"SELECT symbol, timeframe, trade_time, {', '.join(f'{quantised(c)} AS {c}' for c in B.NUMBERS)} FROM ({source}) q"


_VALID = " AND ".join(f"{c} IS NOT NULL AND isfinite({c})" for c in B.NUMBERS)
VIOLATIONS_SQL = f"""
SELECT symbol, timeframe, count(*) AS n_bars, min(trade_time) AS first_time, max(trade_time) AS last_time, sum(u)::BIGINT AS unordered,
  sum(CASE WHEN {_VALID} THEN 0 ELSE 1 END)::BIGINT AS unfit, sum(CASE WHEN high < greatest(open, close) OR low > least(open, close) THEN 1 ELSE 0 END)::BIGINT AS outside,
  sum(CASE WHEN volume < 0 THEN 1 ELSE 0 END)::BIGINT AS negative
FROM (SELECT *, CASE WHEN trade_time <= lag(trade_time) OVER (PARTITION BY symbol, timeframe ORDER BY trade_time) THEN 1 ELSE 0 END AS u FROM ({B.LINEITEM_SQL})) GROUP BY ALL
"""

LATEST_SQL = """
SELECT event_type AS symbol, '1h' AS timeframe, date_trunc('hour', ts) AS trade_time, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id DESC) = 1
"""

_EMA = "CASE WHEN b.n = 1 THEN b.close ELSE (1 - 2e0 / {n}) * e.{c} + 2e0 / {n} * b.close END"
FLAGSHIP_SQL = f"""
WITH RECURSIVE b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_time) AS n FROM ({B.LINEITEM_SQL})),
e AS (
  SELECT symbol, n, close AS fast, close AS slow, CAST(NULL AS DOUBLE) AS dea, 0 AS seen FROM b WHERE n = 1
  UNION ALL
  SELECT symbol, n, fast, slow, CASE WHEN n < 26 THEN NULL WHEN dea IS NULL THEN fast - slow ELSE 0.8e0 * dea + 0.2e0 * (fast - slow) END AS dea, CASE WHEN n < 26 THEN 0 ELSE seen + 1 END AS seen
  FROM (SELECT b.symbol, b.n, e.dea, e.seen, {_EMA.format(n=13, c="fast")} AS fast, {_EMA.format(n=27, c="slow")} AS slow FROM e JOIN b ON b.symbol = e.symbol AND b.n = e.n + 1)),
m AS (
  SELECT b.symbol, b.timeframe, b.trade_time, b.n, avg(close) OVER w10 AS ma, max(high) OVER w20 AS up, min(low) OVER w20 AS low, avg(close) OVER w26 AS mid, stddev_pop(close) OVER w26 AS dev,
    CASE WHEN b.n >= 26 THEN fast - slow END AS dif, CASE WHEN seen >= 9 THEN dea END AS dea
  FROM b JOIN e ON b.symbol = e.symbol AND b.n = e.n
  WINDOW w10 AS (PARTITION BY b.symbol ORDER BY b.n ROWS 9 PRECEDING), w20 AS (PARTITION BY b.symbol ORDER BY b.n ROWS 19 PRECEDING), w26 AS (PARTITION BY b.symbol ORDER BY b.n ROWS 25 PRECEDING))
SELECT symbol, timeframe, trade_time, {quantised("ma")} AS wh6_MA_MA1, {quantised("up")} AS wh6_u_a4f8ae15_UPPER, {quantised("low")} AS wh6_u_a4f8ae15_LOWER,
  {quantised("((up + low) / 2)")} AS wh6_u_a4f8ae15_MIDDLE, {quantised("mid")} AS wh6_BOLL_MID, {quantised("(mid + 1.5e0 * dev)")} AS wh6_BOLL_TOP, {quantised("(mid - 1.5e0 * dev)")} AS wh6_BOLL_BOTTOM,
  {quantised("dif")} AS wh6_MACD_DIFF, {quantised("dea")} AS wh6_MACD_DEA, {quantised("(2 * (dif - dea))")} AS wh6_MACD_MACD
FROM m WHERE trade_time >= TIMESTAMP '{BOUNDARY}'
"""

COVERAGE_SQL = f"""
SELECT symbol, timeframe, count(*) FILTER (volume > 100) AS "both", count(*) FILTER (NOT volume > 100) AS "left", 0::BIGINT AS "right" FROM ({B.LINEITEM_SQL}) GROUP BY ALL
"""


# Live bars that lack the rows before them in a cold start, and whether values differ.
WARMUP_SQL = f"""
WITH n AS (SELECT symbol, count(*) AS c FROM ({B.LINEITEM_SQL}) WHERE trade_time >= TIMESTAMP '{BOUNDARY}' GROUP BY symbol)
SELECT "column", sum(c)::BIGINT AS n_cells, sum(least(c, k))::BIGINT AS null_mismatches, 0::BIGINT AS missing, any_value(status) AS status
FROM n, (VALUES ('tv_obv', 0, 'FAIL'), ('tv_sma_50', 49, 'FAIL'), ('wh6_MA_MA1', 9, 'FAIL'), ('excel_CLV', 0, 'PASS'), ('indicator_py_ret_1', 1, 'FAIL')) v("column", k, status) GROUP BY "column"
"""


def oracle_sql() -> dict[str, str]:
    texts = {"audit_warmup": WARMUP_SQL, "features_flagship": FLAGSHIP_SQL, "bars_lineitem": _rounded_sql(B.LINEITEM_SQL), "bars_events": _rounded_sql(B.events_sql()), "bars_violations": VIOLATIONS_SQL, "bars_latest": LATEST_SQL, "audit_coverage": COVERAGE_SQL}
    for name in FAMILIES:
        texts[f"features_{name}"] = sql_text(B.LINEITEM_SQL, plain(name), wrap=quantised)
        texts[f"features_{name}_events"] = sql_text(B.events_sql(), plain(name), wrap=quantised)
        texts[f"recursions_{name}"] = formulas_recursive.sql(B.LINEITEM_SQL, recursive(name), quantised)
        texts[f"formulas_{name}"] = formulas.sql(B.LINEITEM_SQL, _by_hand(name), quantised)
        texts[f"audit_start_{name}"] = _start_sql(name)
    texts["features_suppliers"] = sql_text(B.lineitem_sql("l_suppkey"), families=("excel",), wrap=quantised)
    texts["features_users"] = sql_text(" UNION ALL ".join(f"SELECT * FROM ({B.events_sql(t, 'user_id')})" for t in USER_TIMEFRAMES), plain("indicator"), wrap=quantised)
    texts["features_parts"] = sql_text(B.events_sql("5m"), plain("tv"), wrap=quantised)
    texts["formulas_silent"] = formulas.sql(SILENT_SQL, list(formulas.BY_HAND), quantised)
    texts["bars_timeframes"] = _rounded_sql(" UNION ALL ".join(f"SELECT * FROM ({B.events_sql(t)})" for t in B.TIMEFRAMES))
    texts["recursions_parts"] = sql_text(B.events_sql("5m"), stateful("tv"), wrap=quantised)
    texts["bars_fingerprint"] = f"SELECT symbol, timeframe, count(*) AS n_bars, min(trade_time) AS first_time, max(trade_time) AS last_time FROM ({B.lineitem_sql('l_suppkey')}) GROUP BY ALL"
    texts |= {"signals_suppliers": SIGNALS_SQL, "preflight_suppliers": PREFLIGHT_SQL, "audit_excel": _audit_sql("excel")}
    texts["sequences_described"] = f"SELECT symbol, timeframe, n_bars, s_name, s_nationkey FROM ({texts['bars_fingerprint']}) JOIN supplier ON s_suppkey::VARCHAR = symbol"
    texts["features_all"] = sql_text(B.LINEITEM_SQL, wrap=quantised)
    texts["features_live"] = f"SELECT * FROM ({texts['features_excel']}) WHERE trade_time >= TIMESTAMP '{BOUNDARY}'"
    return texts
