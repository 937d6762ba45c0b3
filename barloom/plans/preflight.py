"""What is wrong with the sources, before anything is built; nothing is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.bars import KEYS, NUMBERS, TIME, rebase

#: Counts of one source, and of a sequence in both; all must be zero.
BROKEN = ("repeated", "untimed", "unfit", "outside", "negative", "misplaced")
MATCHED = ("no_market", "no_history", "outside_profile")


def _facts(market: DataFrame, history: DataFrame, start: str) -> DataFrame:
    """One row for each source and sequence with BROKEN.

    Both sources are one relation.  Bars meet by their times first and these by sequence, so
    a sequence that holds most rows is spread like all others, and nothing is sorted.
    """
    early = F.col(TIME) < F.to_timestamp(F.lit(start))
    a = rebase(market).withColumns({"source": F.lit("market"), "misplaced": early})
    b = rebase(history).withColumns({"source": F.lit("history"), "misplaced": ~early})
    unfit = F.expr(" OR ".join(f"{c} IS NULL OR isnan({c}) OR abs({c}) = CAST('Infinity' AS DOUBLE)" for c in NUMBERS))
    broken = {"unfit": unfit, "outside": ~unfit & F.expr("high < greatest(open, close) OR low > least(open, close)"), "negative": F.col("volume") < 0, "misplaced": F.col("misplaced")}
    times = a.unionByName(b).groupBy("source", *KEYS, TIME).agg(F.count("*").alias("n"), *[F.count_if(x).alias(k) for k, x in broken.items()])
    timed = F.col(TIME).isNotNull()
    sums = {"n_bars": F.col("n"), "repeated": F.when(timed, F.col("n") - 1).otherwise(0), "untimed": F.when(timed, 0).otherwise(F.col("n")), **{k: F.col(k) for k in broken}}
    return times.groupBy("source", *KEYS).agg(*[F.sum(x).cast("long").alias(k) for k, x in sums.items()])


def preflight(market: DataFrame, history: DataFrame, *, start: str, symbols: Sequence[str] | None = None, timeframes: Sequence[str] | None = None) -> DataFrame:
    """(source, symbol, timeframe, finding, n, status): all rules of both sources and between them.

    market are the bars from `start` on, history those before it.  Of each source:
    repeated and missing times, numbers that are missing or not finite, high and low that do
    not enclose open and close, negative volumes, and bars on the wrong side of `start`.
    Between them: `no_history` for a market sequence without history; `no_market` for each
    symbol and timeframe of the profile without market bars; `outside_profile` for market
    sequences that the profile does not name.  History of other sequences is not looked at,
    as no build reads it.  Findings are FAIL where n is not 0.  One plan; empty sources give
    what the profile lacks, or nothing.
    """
    facts = _facts(market, history, start)
    counted = lambda source: F.coalesce(F.sum(F.when(F.col("source") == source, F.col("n_bars"))), F.lit(0)).alias(source)
    by_source = F.collect_list(F.struct("source", *BROKEN)).alias("facts")  # two at most
    sequences = facts.groupBy(*KEYS).agg(counted("market"), counted("history"), by_source)
    inside = F.lit(True)
    for name, wanted in (("symbol", symbols), ("timeframe", timeframes)):
        if wanted is not None:
            inside &= F.coalesce(F.col(name).isin(*wanted), F.lit(False))
    wanted = F.lit(False)
    if symbols and timeframes:  # the profile's own rows, so that an absent sequence is one with no bars
        spark = market.sparkSession
        profile = spark.range(1).select(F.explode(F.lit(list(symbols))).alias("symbol")).select("symbol", F.explode(F.lit(list(timeframes))).alias("timeframe"), F.lit(True).alias("wanted"))
        sequences = sequences.join(profile, list(KEYS), "full_outer")
        wanted = F.coalesce("wanted", F.lit(False))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    has = n("market") > 0
    between = {"no_market": wanted & ~has, "no_history": has & (n("history") == 0), "outside_profile": has & ~inside}
    own = F.flatten(F.transform("facts", lambda f: F.array(*[F.struct(f["source"].alias("source"), F.lit(k).alias("finding"), f[k].alias("n")) for k in BROKEN])))
    both = F.array(*[F.struct(F.lit("both").alias("source"), F.lit(k).alias("finding"), between[k].cast("long").alias("n")) for k in MATCHED])
    rows = sequences.where(has | wanted).select(*KEYS, F.explode(F.concat(F.coalesce(own, F.array()), both)).alias("r"))
    return rows.select("r.source", *KEYS, "r.finding", "r.n", F.when(F.col("r.n") > 0, "FAIL").otherwise("PASS").alias("status"))


def require_clean(findings: DataFrame) -> None:
    """An error that names the findings that fail, and how many sequences have each."""
    failed = findings.where("status = 'FAIL'").groupBy("source", "finding").agg(F.count("*").alias("n")).orderBy("source", "finding").collect()  # one row for each rule at most
    if failed:
        raise ValueError("preflight: " + ", ".join(f"{r.source} {r.finding} in {r.n}" for r in failed))


def exactly_one(rows: DataFrame, lookup: DataFrame, on: Sequence[str] = KEYS) -> DataFrame:
    """rows with the columns of lookup's row of the same keys; a row with none or several fails the job.

    The guard is a filter of the plan, so it costs no job of its own and no later step can
    leave it out.  Null keys match nothing, so they fail.
    """
    added = [c for c in lookup.columns if c not in on]
    clash = sorted(set(added) & set(rows.columns))
    if clash:
        raise ValueError(f"both sides have {clash}")
    one = lookup.groupBy(*on).agg(F.count("*").alias("__n"), F.any_value(F.struct(F.lit(1).alias("__there"), *added)).alias("__row"))
    named = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in on])
    found = F.coalesce("__n", F.lit(0))
    guard = F.when(found == 1, F.lit(True)).otherwise(F.raise_error(F.concat(found.cast("string"), F.lit(" matches, not one: "), named)).cast("boolean"))
    return rows.join(one, list(on), "left").where(guard).select(*rows.columns, *[F.col(f"__row.{c}").alias(c) for c in added])
