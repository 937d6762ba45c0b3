"""Stored bars and features: layouts by folder, CSV and Parquet tables, file inventories."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bars import KEYS, SCHEMA, TIME

#: Encodings that a CSV is tried in, in this order.
ENCODINGS = ("UTF-8", "GB18030")


def _glob(name: str) -> str:
    """A folder's name as a pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?,^])", r"\\\1", name)


def read_layout(spark: SparkSession, root: str, schema: T.StructType = SCHEMA, *, symbols: Sequence[str] | None = None, timeframes: Sequence[str] | None = None, years: Sequence[int] | None = None) -> DataFrame:
    """Parquet under root/<symbol>/<timeframe>/<year>/: symbol and timeframe come from the folders.

    Only the folders of the scope are listed, and only their files are opened.  Each named
    sequence must be there, each year of it need not.  Codes are kept as strings and case
    matters, so names like `a` and `A` stay apart.
    """
    for name, wanted in (("symbols", symbols), ("timeframes", timeframes), ("years", years)):
        if wanted is not None and (not wanted or len(set(wanted)) != len(wanted)):
            raise ValueError(f"{name} must be distinct and not none")
    stored = T.StructType([f for f in schema if f.name not in KEYS])
    year = "*" if years is None else "{" + ",".join(str(int(y)) for y in years) + "}"
    every = lambda names: ["*"] if names is None else map(_glob, names)
    paths = [f"{root}/{s}/{t}/{year}" for s, t in product(every(symbols), every(timeframes))]
    df = spark.read.schema(stored).option("pathGlobFilter", "*.parquet").parquet(*paths)
    parts = F.split(F.col("_metadata.file_path"), "/")
    code = lambda i: F.url_decode(F.replace(F.element_at(parts, i), F.lit("+"), F.lit("%2B")))
    return df.select(code(-4).alias("symbol"), code(-3).alias("timeframe"), *[f.name for f in stored])


def write_layout(bars: DataFrame, root: str) -> None:
    """Parquet by symbol, timeframe and year, each sorted by time; an existing root is an error."""
    df = bars.withColumn("year", F.year(TIME))
    df.repartition("symbol", "timeframe", "year").sortWithinPartitions(TIME).write.mode("errorifexists").partitionBy(*KEYS, "year").option("compression", "snappy").parquet(root)


def discover(spark: SparkSession, root: str, *, pattern: str = "*", exclude: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """(path, bytes, modified) of the files under root, sorted; `exclude` are parts of paths.

    Only names are listed, contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    files = files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    for part in exclude or []:
        files = files.where(~F.col("path").contains(part))
    files = files.orderBy("path")
    return files if limit is None else files.limit(limit)


def file_hashes(spark: SparkSession, root: str, *, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256) of the files under root; each file is hashed in a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


#: Hexadecimal digits of a sequence's digest that name its branch of the tree.
BRANCH = 3


def digest_tree(spark: SparkSession, root: str, *, pattern: str = "*.parquet") -> DataFrame:
    """(level, branch, symbol, timeframe, year, file, digest, files, bytes): contents of root/<symbol>/<timeframe>/<year>/.

    Leaves are SHA-256 of the files' bytes; a year, a sequence, a branch (4,096 of them at
    most) and the root are SHA-256 of what is below them, in order of names.  So two trees
    differ only on the way to what differs.  Folders may be `name=value`, escaped as Spark
    writes them.
    """
    found = file_hashes(spark, root, pattern=pattern)
    parts = F.split("path", "/")
    named = lambda x: F.url_decode(F.replace(F.regexp_replace(x, "^[a-z]+=", ""), F.lit("+"), F.lit("%2B")))
    value = lambda i: F.when(F.element_at(parts, i).rlike("^[a-z]+="), named(F.element_at(parts, i))).otherwise(F.element_at(parts, i))
    leaf = found.select(value(-4).alias("symbol"), value(-3).alias("timeframe"), value(-2).alias("year"), F.element_at(parts, -1).alias("file"), F.col("sha256").alias("digest"), F.lit(1).cast("long").alias("files"), "bytes")
    leaf = leaf.withColumn("branch", F.substring(F.sha2(F.concat_ws("/", *KEYS), 256), 1, BRANCH))
    keys = ["branch", *KEYS, "year", "file"]

    def above(below: DataFrame, depth: int) -> DataFrame:
        """A group is the years' files, a sequence's years, a branch's sequences, or the branches."""
        named = F.struct(F.col(keys[depth]) if depth else F.col("branch"), *([F.col("timeframe")] if depth == 1 else []), "digest")
        text = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(named)), lambda x: x.cast("string")))
        return below.groupBy(*keys[:depth]).agg(F.sha2(text, 256).alias("digest"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))

    year = above(leaf, 4)
    sequence = above(year, 3)
    branch = above(sequence, 1)
    levels = {"file": leaf, "year": year, "sequence": sequence, "branch": branch, "root": above(branch, 0)}
    rows = [df.select(F.lit(level).alias("level"), *[F.col(k) if k in df.columns else F.lit(None).cast("string").alias(k) for k in keys], "digest", "files", "bytes") for level, df in levels.items()]
    return reduce(DataFrame.unionByName, rows)


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """(level, branch, symbol, timeframe, year, file, before, after) of all nodes of two trees that differ; null where one is not."""
    keys = ["level", "branch", *KEYS, "year", "file"]
    a, b = before.select(*keys, F.col("digest").alias("x")).alias("a"), after.select(*keys, F.col("digest").alias("y")).alias("b")
    same = reduce(lambda p, q: p & q, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = a.join(b, same, "full_outer").where(~F.col("x").eqNullSafe(F.col("y")))
    return both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], F.col("x").alias("before"), F.col("y").alias("after"))


def header(spark: SparkSession, path: str) -> list[str]:
    """A table's column names; of a CSV only the first line is read."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path).columns
    first = spark.read.text(path).select(F.col("value").cast("binary").alias("line")).first()
    raw = bytes(first.line if first else b"").rstrip(b"\r").removeprefix(b"\xef\xbb\xbf")
    for encoding in ENCODINGS:
        try:
            return raw.decode(encoding).split(",")
        except UnicodeDecodeError:
            continue
    raise ValueError(f"{path} is in none of {ENCODINGS}")


def _decoded(spark: SparkSession, path: str, schema: T.StructType, names: list[str]) -> DataFrame:
    """A GB18030 CSV: Spark reads the lines, tasks decode them, Spark parses the fields."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.decode("gb18030").rstrip("\r") for x in batch.column(0).to_pylist()], pa.string())], names=["line"])

    lines = spark.read.text(path).select(F.col("value").cast("binary")).mapInArrow(decode, "line string")
    return lines.where(F.col("line") != ",".join(names)).select(F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)).alias("r")).select("r.*")


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV or Parquet table; a CSV that is not valid UTF-8 is read as GB18030, numbers are doubles."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        names = header(spark, path)
        texts = {*KEYS, TIME, "contract_code", "trade_date"}
        schema = T.StructType([T.StructField(n, T.StringType() if n in texts else T.DoubleType()) for n in names])
        plain = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count() == 0
        df = spark.read.schema(schema).option("header", True).csv(path) if plain else _decoded(spark, path, schema, names)
        if TIME in names:
            df = df.withColumn(TIME, F.to_timestamp(TIME))
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return df if columns is None else df.select(*columns)
