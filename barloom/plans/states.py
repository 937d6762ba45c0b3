"""Pasts of sequences as a table, and features of new bars that start from it.

A row holds, for each sequence, its last time, the numbers of recursions and running sums
(by the signatures of their nodes), and the last bars that frames still reach.  With it, a
later job computes the features of new bars without reading one older bar, and a stream
begins with its history.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import Expr
from ..functions.sql import Over, reach, stages
from ..functions.states import step
from ..operators.registry import FAMILIES, select
from ..session import ship, stored
from ..sources.bars import KEYS, NUMBERS, SCHEMA, TIME, rebase
from .carried import CARRIED, over_columns, rounds

NEW = "__new"
PAST = T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))


def stream_pasts(history: DataFrame, columns: list[str]) -> DataFrame:
    """(symbol, timeframe, last, past) of every sequence, for a stream of these columns to begin with.

    One kernel call for each sequence; last is in microseconds.
    """
    ship(history.sparkSession)
    outputs = select(columns)
    schema = T.StructType([*SCHEMA.fields[:2], T.StructField("last", T.LongType()), T.StructField("past", PAST)])

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by(TIME)
        _, kept = step(outputs, {c: table.column(c).to_numpy().astype(float) for c in NUMBERS}, None)
        when = table.column(TIME)[-1].cast(pa.timestamp("us", table.column(TIME).type.tz)).value
        return pa.table({**{k: table.column(k).slice(0, 1) for k in KEYS}, "last": pa.array([when], pa.int64()), "past": pa.array([list(kept.items())], pa.map_(pa.string(), pa.list_(pa.float64())))})

    return rebase(history).groupBy(*KEYS).applyInArrow(kernel, schema)


class Split:
    """The wanted columns as kernels (what carries state) and windows that reach back a known number of rows."""

    def __init__(self, columns: list[str] | None, families: tuple[str, ...]):
        self.wanted = select(columns, families)
        self.scans = {k: e for k, e in self.wanted.items() if e.scan}
        plain = {k: e for k, e in self.wanted.items() if not e.scan}
        sums = [e for nodes in rounds(plain.values()) for e in nodes if e.op in CARRIED]
        #: Running sums that windows stand on, as columns.
        self.sums = {f"__u{i}": e for i, e in enumerate(sums)}
        known: dict[Expr, Expr] = {e: Expr("column", p=(name, True) if e.inf else (name,)) for name, e in self.sums.items()}
        self.plain = {k: over_columns(e, known) for k, e in plain.items()}
        self.kernels = {**self.scans, **self.sums}
        #: Rows that windows reach back, this one included.
        self.back = max(reach(self.plain).values(), default=1)
        self.row = T.StructType([T.StructField(TIME, T.TimestampType()), *(T.StructField(c, T.DoubleType()) for c in (*NUMBERS, *self.sums))])
        self.schema = T.StructType([*SCHEMA.fields[:2], T.StructField("last", T.TimestampType()), T.StructField("past", PAST), T.StructField("tail", T.ArrayType(self.row))])


def advance(bars: DataFrame, pasts: DataFrame | None, *, columns: list[str] | None = None, families: tuple[str, ...] = FAMILIES) -> tuple[DataFrame, DataFrame]:
    """Features of new bars, and the pasts after them; pasts None: all sequences begin here.

    Every new bar must be later than the last of its sequence's past, or the job fails; a
    sequence without a past begins.  The values are those of the whole sequence, to the
    last bit: recursions and sums go on from their numbers, windows are the same SQL over the
    last bars and the new ones.  No older bar is read.  Sequences without new bars keep
    their past.
    """
    spark = ship(bars.sparkSession)
    how = Split(columns, families)
    made = [*how.scans, *how.sums]
    found = T.StructType([*SCHEMA.fields, *(T.StructField(c, T.DoubleType()) for c in made), T.StructField(NEW, T.BooleanType()), T.StructField("past", PAST)])
    if pasts is None:
        pasts = spark.createDataFrame([], how.schema)

    def kernel(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        new = new.sort_values(TIME)
        tail, kept = pd.DataFrame(), None
        if len(old):
            kept = {k: list(v) for k, v in dict(old["past"][0]).items()}
            tail = pd.DataFrame([r.asDict() if hasattr(r, "asDict") else dict(r) for r in old["tail"][0]])
            if len(new) and new[TIME].iloc[0] <= old["last"][0]:
                raise ValueError(f"a bar of {new[KEYS[0]].iloc[0]} is not later than its past")
        elif not len(new):
            return pd.DataFrame(columns=[f.name for f in found])
        key = (new if len(new) else old).iloc[0]
        if len(new) and how.kernels:
            values, kept = step(how.kernels, {c: new[c].to_numpy(float) for c in NUMBERS}, kept)
            new = pd.concat([new, pd.DataFrame(dict(zip(made, values, strict=True)), index=new.index)], axis=1)
        out = pd.concat([tail.assign(**{NEW: False}), new.assign(**{NEW: True})], ignore_index=True) if len(tail) else new.assign(**{NEW: True}).reset_index(drop=True)
        out = out.assign(**{k: key[k] for k in KEYS}).reindex(columns=[f.name for f in found])
        # What is kept stands beside the last row.
        out["past"] = [None] * (len(out) - 1) + [kept or {}]
        return out

    both = rebase(bars).groupBy(*KEYS).cogroup(pasts.groupBy(*KEYS)).applyInPandas(kernel, found)
    rows = stored(both, "advanced")
    df = rows.select(*KEYS, TIME, *NUMBERS, *made, NEW)
    for items in stages(how.plain, Over(KEYS, TIME), [*KEYS, TIME, NEW, *how.scans]):
        df = df.selectExpr(*items)
    features = df.where(NEW).select(*KEYS, TIME, *how.wanted)
    last = F.struct(TIME, *NUMBERS, *how.sums)
    order = f"row_number() OVER (PARTITION BY {', '.join(KEYS)} ORDER BY {TIME} DESC)"
    kept = rows.select(*KEYS, TIME, *NUMBERS, *how.sums, "past").withColumn("k", F.expr(order)).where(F.col("k") <= max(1, how.back - 1))
    # A group is the last rows that frames reach: some hundred for each sequence.
    after = kept.groupBy(*KEYS).agg(F.max(TIME).alias("last"), F.max_by("past", TIME).alias("past"), F.array_sort(F.collect_list(last)).alias("tail"))
    return features, after.select(*[F.col(f.name).cast(f.dataType) if f.name != "past" else F.col("past") for f in how.schema])
