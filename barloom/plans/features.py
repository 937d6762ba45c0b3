"""Features of bars.

Columns without recursion are SQL windows over (sequence, time): one exchange and one
sort serve all their stages.  Columns with recursion are computed by one Arrow kernel
for each sequence.  Asked for both, the kernels run on the same partitions first, from
nine narrow columns, and the windows follow.

With `kernels` all columns come from kernels that take many sequences in one call: a frame of
n rows costs the JVM n steps for each row and column, so tables of many sequences are mostly
frames.

A sequence is one task by default.  With `split` it is cut into parts of days, and a part is
a task: frames get the days before that they reach, and what carries state from row to row
is computed by parts as `carried` tells.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from itertools import chain
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import recursive_sql
from ..functions.expr import Expr
from ..functions.kernels import evaluate
from ..functions.sql import Over, needed, query, stages
from ..operators.registry import FAMILIES, select
from ..session import ship
from ..sources.bars import KEYS, NUMBERS, TIME, rebase
from .carried import DAY, OWN, PART, compute_parts

OVER = Over(KEYS, TIME)
#: Bars of a kernel call, if there are as many; the last sequence is left to the next call.
TOGETHER = 60_000


def windows(bars: DataFrame, outputs: dict[str, Expr], carried: list[str], over: Over = OVER) -> DataFrame:
    """Outputs without recursion, by stages of SELECTs."""
    df = bars
    for items in stages(outputs, over, carried):
        df = df.selectExpr(*items)
    return df


def parts(bars: DataFrame, rows: int, back: int) -> DataFrame:
    """symbol, timeframe, day, part and whether the day is the part's own or only stands before it.

    A part is the days that begin in the same `rows` rows of their sequence; days with one
    of the back - 1 rows before a part stand before it.  The only rows that meet in one task
    are a sequence's days with their counts.
    """
    days = bars.groupBy(*KEYS, F.date_trunc("day", TIME).alias(DAY)).agg(F.count("*").alias("n"))
    over = f"OVER (PARTITION BY {', '.join(KEYS)} ORDER BY"
    days = days.selectExpr("*", f"sum(n) {over} {DAY}) AS until")
    days = days.selectExpr("*", f"CAST(floor((until - n) / {rows}) AS BIGINT) AS {PART}")
    # What begins behind a day, if it is another part; parts that begin within reach are those of the next days' ends.
    days = days.selectExpr("*", f"CASE WHEN lead({PART}) {over} until) <> {PART} THEN lead({PART}) {over} until) END AS behind")
    near = f"collect_list(behind) {over} until RANGE BETWEEN CURRENT ROW AND {back - 2}L FOLLOWING)" if back > 1 else "CAST(array() AS ARRAY<BIGINT>)"
    days = days.selectExpr("*", f"{near} AS near")
    return days.selectExpr(*KEYS, DAY, f"inline(concat(array(struct({PART}, true AS {OWN})), transform(near, p -> struct(p AS {PART}, false AS {OWN}))))")


def recursions(bars: DataFrame, outputs: dict[str, Expr]) -> DataFrame:
    """bars with outputs that need recursion; one kernel call for each sequence."""
    names, nodes = list(outputs), list(outputs.values())
    schema = T.StructType([*bars.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    spot = [bars.columns.index(c) for c in NUMBERS]
    when = bars.columns.index(TIME)

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by(table.column_names[when])
        bars = {c: table.column(i).to_numpy() for c, i in zip(NUMBERS, spot, strict=True)}
        for name, values in zip(names, evaluate(nodes, bars), strict=True):
            table = table.append_column(name, pa.array(values, from_pandas=True))
        return table

    return bars.groupBy(*KEYS).applyInArrow(kernel, schema)


def begins(table: pa.Table) -> np.ndarray:
    """The rows of a sorted table at which its sequences begin."""
    new = np.arange(table.num_rows) == 0
    for key in KEYS:
        column = table.column(key)
        before, now = column.slice(0, max(0, table.num_rows - 1)), column.slice(1)
        other = pc.or_(pc.fill_null(pc.not_equal(before, now), False), pc.xor(pc.is_null(before), pc.is_null(now)))
        new[1:] |= other.to_numpy()
    return np.flatnonzero(new)


def abreast(bars: DataFrame, outputs: dict[str, Expr], finish: Callable[[np.ndarray], np.ndarray] | None = None, together: int = TOGETHER, dealt: bool = False) -> DataFrame:
    """symbol, timeframe, trade_time and the outputs, put through `finish`; a kernel call for many sequences.

    A sequence of more than `together` rows goes on from call to call.  Bars that are dealt
    have all rows of a sequence in one partition already, in order, and stay as they are.
    """
    names, nodes = list(outputs), list(outputs.values())
    reads = sorted({e.p[0] for e in needed(nodes) if e.op == "column"})
    slim = bars.select(*KEYS, TIME, *(reads or ["close"]))
    schema = T.StructType([*slim.schema.fields[:3], *(T.StructField(n, T.DoubleType()) for n in names)])

    def made(table: pa.Table, **which) -> list[pa.RecordBatch]:
        values = evaluate(nodes, {c: table.column(c).to_numpy() for c in table.column_names[3:]}, **which)
        columns = [*table.columns[:3], *(pa.array(finish(v) if finish else v, from_pandas=True) for v in values)]
        return pa.table(columns, names=schema.names).to_batches(max_chunksize=16_384)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        open_, held = None, []  # the last row of a sequence that may go on, and what it goes on from
        for batch in chain(batches, [None]):
            if batch is not None:
                kept.append(batch)
                rows += batch.num_rows
                if rows < together:
                    continue
            if not rows:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            if open_ is not None:
                first = begins(pa.concat_tables([open_, table]))[1:] - 1  # those after the open one's rows
                until = int(first[0]) if len(first) else table.num_rows
                if until:
                    yield from made(table.slice(0, until), held=held)
                open_ = None if until < table.num_rows else table.slice(until - 1)
                table = table.slice(until)
            starts = begins(table)
            if len(starts) > 1 and batch is not None:
                last = int(starts[-1])
                yield from made(table.slice(0, last), begins=starts[:-1])
                table = table.slice(last)
            elif table.num_rows and batch is None:
                yield from made(table, begins=starts)
            elif table.num_rows >= together:
                held = []
                yield from made(table, held=held)
                open_, table = table.slice(table.num_rows - 1), table.slice(table.num_rows)
            kept, rows = table.to_batches(), table.num_rows

    return (slim if dealt else slim.repartition(*KEYS).sortWithinPartitions(*KEYS, TIME)).mapInArrow(kernel, schema)


def compute(bars: DataFrame, *, columns: list[str] | None = None, families: tuple[str, ...] = FAMILIES, split: int | None = None, kernels: bool = False, finish: Callable[[np.ndarray], np.ndarray] | None = None, dealt: bool = False) -> DataFrame:
    """symbol, timeframe, trade_time and the wanted columns of every bar.

    All supplied bars are history: cumulative columns begin at a sequence's first bar.
    With split, every sequence is cut into parts of days of about so many rows and all
    columns are computed by parts (see `carried`): windows with the rows before that they
    reach, means, sums and run lengths by blocked scans, branching recursions by
    speculation that is checked.  Parts are counted first, so bars are read twice, or stored
    if any column carries state.  A bar without a time is in no day and has no place in the
    order: with split it is left out.

    With kernels, kernels compute the windows too, many sequences in one call, and `finish`
    is applied to each column there.  With dealt too, bars have each sequence in one partition and in order.
    """
    ship(bars.sparkSession)
    wanted = select(columns, families)
    bars = df = rebase(bars)
    if split:
        return compute_parts(bars, wanted, split, parts)
    if kernels:
        return abreast(bars, wanted, finish, dealt=dealt)
    scans = {k: e for k, e in wanted.items() if e.scan}
    plain = {k: e for k, e in wanted.items() if not e.scan}
    if scans:
        df = recursions(df, scans)
    if plain:
        df = windows(df, plain, [*KEYS, TIME, *scans])
    return df.select(*KEYS, TIME, *wanted)


def boundary(start: str, zone: str | None = None) -> Column:
    """The instant at which live bars begin: local to zone, or to the session; a text with an offset is an instant already."""
    when = dt.datetime.fromisoformat(start)
    if when.tzinfo is None and zone is None:
        return F.to_timestamp(F.lit(start))
    when = when if when.tzinfo else when.replace(tzinfo=ZoneInfo(zone))
    return F.timestamp_micros(F.lit(int(when.timestamp() * 1e6)))


def live_only(history: DataFrame, live: DataFrame, *, start: str, zone: str | None = None, cold_start: bool = False, **options) -> DataFrame:
    """Features of the live bars, computed over history and live bars together.

    History before `start` warms the sequences up and is never returned; the filter
    stands behind the windows.  Without `cold_start` every live sequence must have
    history; live bars before `start` are an error.  The excel family alone also refuses
    a cold start that no sequence needs.
    """
    early = F.col(TIME) < boundary(start, zone)
    if live.where(early).limit(1).count():
        raise ValueError("live bars begin before the boundary")
    past = history.where(early)
    cold = live.select(*KEYS).distinct().join(past.select(*KEYS).distinct(), list(KEYS), "left_anti").limit(1).count() > 0
    if cold and not cold_start:
        raise ValueError("a sequence has no history; allow a cold start to go on")
    if cold_start and not cold and tuple(options.get("families", ())) == ("excel",):
        raise ValueError("every sequence has history; a cold start is not needed")
    return compute(past.unionByName(live), **options).where(~early)


def sql_text(source: str, columns: list[str] | None = None, families: tuple[str, ...] = FAMILIES, wrap=lambda name: name) -> str:
    """The same columns as one SELECT for another engine; recursions need its WITH RECURSIVE."""
    wanted, over = select(columns, families), Over(KEYS, TIME, spark=False)
    recursive = any(e.scan for e in wanted.values())
    inner = f"({recursive_sql.query(wanted, over, [*KEYS, TIME], f'({source})')})" if recursive else query(wanted, over, [*KEYS, TIME], f"({source})")
    return f"SELECT {', '.join([*KEYS, TIME, *(f'{wrap(n)} AS {n}' for n in wanted)])} FROM {inner} q"
