import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom.functions.expr import C, O, avg, cross, number, rising
from barloom.plans.features import windows
from barloom.plans.preflight import exactly_one, preflight, require_clean
from barloom.sources.bars import KEYS, SCHEMA, TIME

NAN = float("nan")


def bars(spark, rows):
    day = lambda i: None if i is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    return spark.createDataFrame([(s, "1day", day(i), *map(float, numbers)) for s, i, *numbers in rows], SCHEMA)


def good(symbol, day):
    return (symbol, day, 2, 3, 1, 2, 5, 0)


def failed(findings):
    return {(r.source, r.symbol, r.finding): r.n for r in findings.where("status = 'FAIL'").collect()}


def test_clean_sources_pass(spark):
    found = preflight(bars(spark, [good("a", 10), good("a", 11)]), bars(spark, [good("a", 1)]), start="2024-01-05", symbols=["a"], timeframes=["1day"])
    assert found.count() == 2 * 6 + 3 and not failed(found)
    require_clean(found)


def test_each_rule_is_found(spark):
    market = bars(spark, [good("a", 10), good("a", 10), good("a", 10), ("a", 11, 2, NAN, 1, 2, 5, 0), ("a", 12, 2, 1, 1, 2, 5, 0), ("a", 13, 2, 3, 1, 2, -5, 0), good("a", 2), good("b", 10), good("a", None)])
    history = bars(spark, [good("a", 1), good("a", 9), good("z", 1), good("z", 1)])
    found = preflight(market, history, start="2024-01-05", symbols=["a", "c"], timeframes=["1day"])
    assert failed(found) == {
        ("market", "a", "repeated"): 2, ("market", "a", "unfit"): 1, ("market", "a", "outside"): 1, ("market", "a", "negative"): 1, ("market", "a", "misplaced"): 1, ("market", "a", "untimed"): 1,
        ("history", "a", "misplaced"): 1, ("both", "b", "no_history"): 1, ("both", "b", "outside_profile"): 1, ("both", "c", "no_market"): 1,
    }
    with pytest.raises(ValueError, match="both no_history in 1.*market repeated in 1"):
        require_clean(found)


def test_empty_sources(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert preflight(none, none, start="2024-01-05").count() == 0
    assert failed(preflight(none, none, start="2024-01-05", symbols=["a"], timeframes=["1day"])) == {("both", "a", "no_market"): 1}


def test_a_hot_sequence_is_not_sorted_in_one_task(spark):
    plan = preflight(bars(spark, [good("a", 1)]), bars(spark, [good("a", 1)]), start="2024-01-05")._jdf.queryExecution().executedPlan().toString()
    first = plan.split("hashpartitioning(source")[-1].split("\n")[0]  # the plan is told from its end
    assert "Window" not in plan and "Sort " not in plan and TIME in first


def test_exactly_one(spark):
    rows = spark.createDataFrame([("a", "1day", 1), ("b", "1day", 2)], "symbol string, timeframe string, n int")
    lookup = spark.createDataFrame([("a", "1day", "x"), ("b", "1day", None), ("c", "1day", "y"), ("c", "1day", "z")], "symbol string, timeframe string, name string")
    assert sorted(map(tuple, exactly_one(rows, lookup).collect())) == [("a", "1day", 1, "x"), ("b", "1day", 2, None)]
    for bad, found in ((rows.union(rows.where("n = 1").withColumn("symbol", F.lit("c"))), "2 matches, not one: c/1day"), (rows.withColumn("timeframe", F.lit("1h")), "0 matches"), (rows.withColumn("symbol", F.lit(None).cast("string")), "0 matches, not one: null/1day")):
        for use in (lambda df: df.collect(), lambda df: df.select("n").collect(), lambda df: df.count()):
            with pytest.raises(PySparkException, match=found):
                use(exactly_one(bad, lookup))
    with pytest.raises(ValueError, match="both sides have"):
        exactly_one(rows, lookup.withColumn("n", F.lit(1)))


def test_cross_and_rising_against_loops(spark):
    closes = [5.0, 6.0, 4.0, 4.0, 7.0, None, 8.0, 3.0, 9.0, 9.0, 2.0]
    rows = [("a", "1day", dt.datetime(2024, 1, 1 + i), 5.0, 5.0, 5.0, c, 1.0, 0.0) for i, c in enumerate(closes)]
    got = windows(spark.createDataFrame(rows, SCHEMA), {"level": number(cross(C, 5)), "own": number(cross(C, O)), "back": number(cross(5, C)), "up": number(rising(C, 2))}, [*KEYS, TIME]).orderBy(TIME).collect()
    for i, r in enumerate(got):
        now, before, two = closes[i], closes[i - 1] if i else None, closes[i - 2] if i > 1 else None
        over = now is not None and before is not None and now > 5 and before <= 5
        under = now is not None and before is not None and now < 5 and before >= 5
        assert (r.level, r.own, r.back, r.up) == (over, over, under, now is not None and two is not None and now > two)
    assert avg(C, 5) is avg(C, 5)
