"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ship
from .files import remove_folder

#: Text bytes that one numpy step holds at once; a longer single text is a step of its own.
STEP_BYTES = 8 << 20

#: Types of computed columns.
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only on one machine, where none is set."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-work-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: For each open `scratch`, the folders that were made since.
_made: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _made:
        made.append(folder)
    return folder


@contextmanager
def scratch() -> Iterator[Callable[[str], None]]:
    """Removes, in the end, all that was written into the shared folder meanwhile; gives a function that keeps a folder.

    For jobs whose results are written inside: a table that is read later would miss its files.
    """
    made: list[str] = []
    kept: set[str] = set()
    _made.append(made)
    try:
        yield kept.add
    finally:
        _made.remove(made)
        for folder in made:
            if folder not in kept:
                remove_folder(folder)


def written(name: str) -> list[str]:
    """Folders of a name that the innermost scratch has seen made."""
    return [f for f in (_made[-1] if _made else []) if re.fullmatch(rf"{re.escape(name)}-[0-9a-f]{{32}}", f.rsplit("/", 1)[-1])]


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not use yet (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def steps(batch: pa.RecordBatch, text: str | int, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Split a record batch into slices of about `limit` text bytes, at least one row each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def map_texts(df: DataFrame, text: str, fields: list[T.StructField], fn: Callable[[list[bytes]], list], keep: list[str], limit: int = STEP_BYTES) -> DataFrame:
    """Columns `keep` of df as they are, then `fields` computed by fn from each text.

    fn gets the UTF-8 texts of a slice of rows (null as empty) and returns one
    sequence for each of the fields.  No shuffle; the memory of a task is bounded by
    a slice, not by its partition.
    """
    inputs = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("\x00text"))
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    n = len(keep)

    added = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, n, limit):
                got = [pa.array(x, f.type) for x, f in zip(fn(as_bytes(part.column(n))), added, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *got], names=[*part.schema.names[:n], *added.names])

    return inputs.mapInArrow(run, schema)
