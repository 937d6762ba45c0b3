import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from barloom.session import local_session

    session = local_session("tests", cores=4, spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def same_rows(df, sql, sf_dir=SMALL):
    """Rows of a Spark query against the same SQL in a second engine."""
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    want, got = con.sql(sql).df(), df.toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda x: sorted(map(tuple, x[columns].astype(object).where(x[columns].notna(), None).values.tolist()), key=repr)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert not [(x, y) for x, y in zip(a, b, strict=True) if x != y][:3]
