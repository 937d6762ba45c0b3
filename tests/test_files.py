import pytest
from pyspark.sql import functions as F

from barloom.plans import audit
from barloom.plans.features import compute
from barloom.sources import files
from barloom.sources.bars import SCHEMA
from tests.test_features import made


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(made(80, 1, "a"), SCHEMA).unionByName(spark.createDataFrame(made(70, 2, "A"), SCHEMA)).cache()


def test_layout_of_bare_folders(spark, bars, tmp_path):
    for symbol in ("a", "A"):
        bars.where(F.col("symbol") == symbol).drop("symbol", "timeframe").coalesce(1).write.parquet(f"{tmp_path}/root/{symbol}/1h/2019")
    got = files.read_layout(spark, f"{tmp_path}/root")
    assert got.columns == bars.columns
    assert got.exceptAll(bars).count() == 0 and got.count() == 150
    found = files.discover(spark, f"{tmp_path}/root", pattern="*.parquet", exclude=["/A/"])
    assert found.count() == 1 and files.discover(spark, f"{tmp_path}/root", limit=1).count() == 1
    assert files.file_hashes(spark, f"{tmp_path}/root", pattern="*.parquet").select("sha256").distinct().count() == 2


def test_written_layout(spark, bars, tmp_path):
    files.write_layout(bars, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 150
    with pytest.raises(Exception, match="exists"):
        files.write_layout(bars, f"{tmp_path}/out")


def test_a_scope_opens_only_its_files(spark, bars, tmp_path):
    """Names with signs that patterns know; a year of a sequence; what is not there is an error."""
    root = f"{tmp_path}/bare"
    for symbol in ("a", "A", "{a,A}", "a b"):
        for timeframe, year in (("1h", 2019), ("1h", 2020), ("4h", 2019)):
            bars.where("symbol = 'a'").drop("symbol", "timeframe").coalesce(1).write.parquet(f"{root}/{symbol}/{timeframe}/{year}")
    seen = lambda df: {tuple(f.split("/bare/")[1].split("/")[:3]) for f in df.inputFiles()}
    assert len(seen(files.read_layout(spark, root))) == 12
    assert seen(files.read_layout(spark, root, symbols=["a"], timeframes=["1h"])) == {("a", "1h", "2019"), ("a", "1h", "2020")}
    assert seen(files.read_layout(spark, root, symbols=["A", "a"], years=[2020])) == {("A", "1h", "2020"), ("a", "1h", "2020")}
    for symbol in ("{a,A}", "a b"):
        got = files.read_layout(spark, root, symbols=[symbol], timeframes=["4h"])
        assert len(got.inputFiles()) == 1 and {tuple(r) for r in got.select("symbol", "timeframe").distinct().collect()} == {(symbol, "4h")}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_layout(spark, root, symbols=["a", "gone"])
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            files.read_layout(spark, root, symbols=bad)


def test_digest_tree(spark, bars, tmp_path):
    """A byte changed in a file of the same size shows on the way from its leaf to the root, and nowhere else."""
    root = f"{tmp_path}/tree"
    for symbol in ("a", "A"):
        for year in (2019, 2020):
            bars.where(F.col("symbol") == symbol).drop("symbol", "timeframe").coalesce(1).write.parquet(f"{root}/{symbol}/1h/{year}")
    files.digest_tree(spark, root).write.parquet(f"{tmp_path}/before")
    before = spark.read.parquet(f"{tmp_path}/before")
    counts = {r.level: r["count"] for r in before.groupBy("level").count().collect()}
    assert counts == {"file": 4, "year": 4, "sequence": 2, "branch": 2, "root": 1} and before.where("level = 'root'").first().files == 4
    assert files.changed(before, files.digest_tree(spark, root)).count() == 0
    path = next(p for p in (tmp_path / "tree/A/1h/2020").iterdir() if p.suffix == ".parquet")
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 1
    path.write_bytes(bytes(data))
    path.with_name(f".{path.name}.crc").unlink()
    found = files.changed(before, files.digest_tree(spark, root)).collect()
    assert sorted((r.level, r.symbol, r.year) for r in found if r.level != "branch" and r.level != "root") == [("file", "A", "2020"), ("sequence", "A", None), ("year", "A", "2020")]
    assert len(found) == 5 and all(r.before != r.after for r in found)
    path.unlink()
    assert {(r.level, r.after is None) for r in files.changed(before, files.digest_tree(spark, root)).collect() if r.symbol == "A"} == {("file", True), ("year", True), ("sequence", False)}


def test_csv_in_two_encodings(spark, tmp_path):
    for encoding in ("utf-8", "gb18030"):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes("trade_time,open,收盘\n2020-01-01 09:00:00,1.5,2\n2020-01-01 10:00:00,,3\n".encode(encoding))
        assert files.header(spark, str(path)) == ["trade_time", "open", "收盘"]
        rows = files.read_table(spark, str(path), ["trade_time", "收盘", "open"]).collect()
        assert rows[0]["收盘"] == 2.0 and rows[1].open is None and rows[0].trade_time.hour == 9
        with pytest.raises(ValueError):
            files.read_table(spark, str(path), ["close"])


def test_audit_of_a_stored_table(bars):
    stored = bars.join(compute(bars, families=("excel",)), ["symbol", "timeframe", "trade_time"]).drop("excel_CLV").withColumn("excel_TYP", F.col("excel_TYP") + 1)
    report = {r.column: r.status for r in audit.audit_features(stored, family="excel").collect()}
    assert len(report) == 66 and {c for c, s in report.items() if s == "FAIL"} == {"excel_CLV", "excel_TYP"}
    light = {r.column: r.status for r in audit.audit_features(stored, family="excel", values=False).collect()}
    assert light["excel_TYP"] == "SKIP_VALUES" and light["excel_CLV"] == "FAIL"
