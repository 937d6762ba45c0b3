import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL, same_rows

NATIVE = [k for k in entry.oracle_sql() if k.startswith(("features", "recursions", "bars", "audit", "formulas", "signals", "preflight", "sequences"))]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in NATIVE if not n.endswith("_events")])
def test_against_a_second_engine(spark, name):
    same_rows(entry.queries()[name](spark, SMALL), entry.oracle_sql()[name])
