"""Audits: stored features against features computed anew, without writing anything."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from ..sources.bars import KEYS, TIME


def paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both sides side by side, with `side`: both, left or right; keys must be unique."""
    on = [*KEYS, TIME]
    a = left.select(*on, F.struct(*[c for c in left.columns if c not in on]).alias("a"))
    b = right.select(*on, F.struct(*[c for c in right.columns if c not in on]).alias("b"))
    side = F.when(F.col("b").isNull(), "left").when(F.col("a").isNull(), "right").otherwise("both")
    return a.join(b, on, "full_outer").withColumn("side", side)


def coverage(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bars of each sequence that both sides have, or only one of them."""
    return paired(left, right).groupBy(*KEYS).pivot("side", ["both", "left", "right"]).count().na.fill(0)


def missing_sequences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sequences that only one side has."""
    a, b = (x.select(*KEYS).distinct() for x in (left, right))
    return a.join(b, list(KEYS), "left_anti").withColumn("only_in", F.lit("left")).unionByName(b.join(a, list(KEYS), "left_anti").withColumn("only_in", F.lit("right")))


#: Counts of a column that tasks add up, and its largest differences.
COUNTS = ("n_cells", "null_mismatches", "infinities", "beyond", "not_identical", "n_abs", "n_rel")
#: Bits of a difference that one pass of `quantiles` looks at.
DIGIT = 16


def _cells(batch: pa.RecordBatch, c: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both sides' values of a column, and where they are missing."""
    sides = [batch.column(i).field(c).cast(pa.float64()) for i in (0, 1)]
    missing = [x.is_null().to_numpy(zero_copy_only=False) for x in sides]
    x, y = (x.fill_null(0.0).to_numpy() for x in sides)
    return x, y, *missing


def _gaps(batch: pa.RecordBatch, c: str) -> tuple[np.ndarray, np.ndarray]:
    """Absolute and relative differences of the cells that both sides have; the relative ones where the left is not zero."""
    x, y, a, b = _cells(batch, c)
    x, y = x[~a & ~b], y[~a & ~b]
    with np.errstate(all="ignore"):
        gap = np.abs(x - y)
        return gap, (gap / np.abs(x))[x != 0]


def tally(pairs: DataFrame, columns: list[str], absolute: float, relative: float) -> DataFrame:
    """One row for each column: COUNTS and the largest differences, added up inside tasks first.

    Cells are looked at as Arrow columns; identical means the same 64 bits, so 0.0 and -0.0
    are not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, most = np.zeros((len(columns), len(COUNTS)), np.int64), np.full((len(columns), 2), np.nan)
        for batch in batches:
            for i, c in enumerate(columns):
                x, y, a, b = _cells(batch, c)
                both = ~a & ~b
                with np.errstate(all="ignore"):
                    gap = np.abs(x - y)
                    far = both & ~(gap <= np.maximum(absolute, np.abs(x) * relative))
                    share = (gap / np.abs(x))[both & (x != 0)]
                infinite = (~a & np.isinf(x)) | (~b & np.isinf(y))
                other = (a != b) | (both & (x.view(np.uint64) != y.view(np.uint64)))
                sums[i] += [len(x), (a != b).sum(), infinite.sum(), far.sum(), other.sum(), both.sum(), len(share)]
                for k, g in enumerate((gap[both], share)):
                    most[i, k] = np.fmax.reduce(g, initial=most[i, k])
        yield pa.RecordBatch.from_arrays([pa.array(columns), *(pa.array(s) for s in sums.T), *(pa.array(m, from_pandas=True) for m in most.T)], names=["column", *COUNTS, "max_abs", "max_rel"])

    schema = f"column string, {', '.join(f'{c} long' for c in COUNTS)}, max_abs double, max_rel double"
    return pairs.mapInArrow(run, schema).groupBy("column").agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS], F.max("max_abs").alias("max_abs"), F.max("max_rel").alias("max_rel"))


def quantiles(pairs: DataFrame, ranks: dict[tuple[str, int], list[int]]) -> dict[tuple[str, int, int], float]:
    """Exact order statistics of differences: ranks, from 0, wanted of (column, 0 absolute or 1 relative).

    The bits of a number that is not negative, as a whole number, have the numbers' order.
    So each pass counts, for what is still open, the next digit of those that begin with the
    digits found; four passes find all 64 bits.  A task holds counts, never values.
    """
    open_ = [(c, k, r, 0, r) for (c, k), rs in ranks.items() for r in rs]
    for shift in range(64 - DIGIT, -1, -DIGIT):
        prefixes: dict[tuple[str, int], list[int]] = {}
        for c, k, _, prefix, _ in open_:
            prefixes.setdefault((c, k), [])
            prefixes[c, k] = sorted({*prefixes[c, k], prefix})

        def run(batches: Iterator[pa.RecordBatch], prefixes=prefixes, shift=shift) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for batch in batches:
                for (c, k), starts in prefixes.items():
                    bits = _gaps(batch, c)[k].view(np.uint64)
                    for start in starts:
                        own = bits if shift + DIGIT == 64 else bits[bits >> np.uint64(shift + DIGIT) == start]
                        for digit, n in zip(*np.unique(own >> np.uint64(shift) & np.uint64((1 << DIGIT) - 1), return_counts=True), strict=True):
                            found[c, k, start, int(digit)] += int(n)
            rows = list(zip(*((*key, n) for key, n in found.items()), strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *(pa.array(x, pa.int64()) for x in rows[1:])], names=["c", "k", "start", "digit", "n"])

        # A prefix of 48 bits is a long; at most as many rows as digits for each rank.
        counted = pairs.mapInArrow(run, "c string, k long, start long, digit long, n long").groupBy("c", "k", "start", "digit").agg(F.sum("n").alias("n")).collect()
        by: dict[tuple, list] = {}
        for r in counted:
            by.setdefault((r.c, r.k, r.start), []).append((r.digit, r.n))
        after = []
        for c, k, rank, prefix, left in open_:
            for digit, n in sorted(by[c, k, prefix]):
                if left < n:
                    after.append((c, k, rank, prefix << DIGIT | digit, left))
                    break
                left -= n
        open_ = after
    return {(c, k, rank): float(np.array([bits], np.uint64).view(float)[0]) for c, k, rank, bits, _ in open_}


def compare(left: DataFrame, right: DataFrame, *, columns: list[str] | None = None, absolute: float = 1e-6, relative: float = 1e-9, share: float = 0.99) -> DataFrame:
    """Per column: cells, null masks that differ, infinities, cells beyond the tolerance, and how far.

    A cell is bad if one side is null and the other is not, or if they differ by more
    than max(absolute, relative * |left|).  Bars of one side only count as missing.
    p99_abs and p99_rel are exact: between the order statistics around `share` of the
    cells that both sides have, by straight interpolation.  Runs its jobs at once; the pairs
    are stored, the report has one row for each column.
    """
    columns = columns or [c for c in left.columns if c in right.columns and c not in (*KEYS, TIME)]
    pairs = stored(paired(left, right).select("side", *(F.when(F.col("side") == "both", F.struct(*[F.col(f"{s}.{c}").cast("double").alias(c) for c in columns])).alias(s) for s in "ab")), "pairs")
    both, missing = pairs.where("side = 'both'").select("a", "b"), pairs.where("side <> 'both'").count()
    rows = {r.column: r.asDict() for r in tally(both, columns, absolute, relative).collect()}
    ranks = {}
    for c, r in rows.items():
        for k, (n, most) in enumerate(((r["n_abs"], r["max_abs"]), (r["n_rel"], r["max_rel"]))):
            if n and most:  # else all differences are zero, or there are none
                ranks[c, k] = sorted({math.floor((n - 1) * share), math.ceil((n - 1) * share)})
    found = quantiles(both, ranks) if ranks else {}
    report = []
    for c in columns:
        r = rows.get(c) or dict.fromkeys((*COUNTS, "max_abs", "max_rel"), 0) | {"max_abs": None, "max_rel": None}
        at = []
        for k, (n, most) in enumerate(((r["n_abs"], r["max_abs"]), (r["n_rel"], r["max_rel"]))):
            if (c, k) in ranks:
                low, high = ranks[c, k][0], ranks[c, k][-1]
                x, y = found[c, k, low], found[c, k, high]
                at.append(x + (y - x) * ((n - 1) * share - low))
            else:
                at.append(most if n else None)
        bad = r["null_mismatches"] + r["beyond"] + r["infinities"] + missing
        report.append((c, r["n_cells"], r["null_mismatches"], r["infinities"], r["beyond"], r["max_abs"], r["max_rel"], at[0], at[1], r["not_identical"], missing, "FAIL" if bad else "PASS"))
    return left.sparkSession.createDataFrame(report, "column string, n_cells long, null_mismatches long, infinities long, beyond long, max_abs double, max_rel double, p99_abs double, p99_rel double, not_identical long, missing long, status string")


def rollup(report: DataFrame) -> DataFrame:
    """The worst status of a report, and its counts."""
    rank = F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "SKIP_VALUES", 1).otherwise(0)
    worst = F.max(rank)
    return report.agg(F.when(worst == 2, "FAIL").when(worst == 1, "SKIP_VALUES").otherwise("PASS").alias("status"), F.count("*").alias("columns"), F.sum("n_cells").alias("n_cells"), F.sum("null_mismatches").alias("null_mismatches"), F.sum("beyond").alias("beyond"))


def audit_features(features: DataFrame, *, family: str, values: bool = True, absolute: float = 1e-6, relative: float = 1e-9) -> DataFrame:
    """A stored feature table, which has its bars' columns too, against features computed anew.

    One row for each column of the family: `FAIL` if it is missing or differs,
    `SKIP_VALUES` if only its presence was asked for, else `PASS`.
    """
    from ..operators.registry import family as columns_of
    from ..sources.bars import SCHEMA
    from .features import compute

    spark = features.sparkSession
    wanted = list(columns_of(family))
    there = [c for c in wanted if c in features.columns]
    empty = "column string, n_cells long, null_mismatches long, infinities long, beyond long, max_abs double, missing long, status string"
    gone = spark.createDataFrame([(c, 0, 0, 0, 0, None, 0, "FAIL") for c in wanted if c not in there], empty)
    if not values or not there:
        return spark.createDataFrame([(c, 0, 0, 0, 0, None, 0, "SKIP_VALUES") for c in there], empty).unionByName(gone)
    anew = compute(features.select(*[f.name for f in SCHEMA]), columns=there)
    report = compare(features.select(*KEYS, TIME, *there), anew, columns=there, absolute=absolute, relative=relative)
    return report.select(*gone.columns).unionByName(gone)
