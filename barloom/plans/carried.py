"""Columns that carry state from row to row, by parts of sequences.

A sequence is cut into parts of days (`features.parts`), a part into blocks of rows.  What
carries state is computed in rounds: nodes of a round stand on bars, on windows and on nodes
of earlier rounds.  There are two ways.

*Blocked scans*, in SQL only.  Means (exponential, Wilder, smoothed), running sums, counts,
products and run lengths are affine in the state at the start of a block: after the block's
first value, `y = p * first + s`, where p and s come from windows inside the block.  One row for
each block says what it does to any state, a fold over the blocks of a sequence gives the
state at each start, and a join hands them back.  Two passes of windows, whatever the length.

*Speculation*, for recursions that branch (parabolic stops, supertrend, trailing stops,
Fisher).  A part starts from nothing some rows before its first one and goes on through its
own; the state it had at its first row is compared, byte for byte, with that in which the
part before ended.  Parts whose states did not meet run again from the right one, until all
meet.  So the values are those of the whole sequence, bit for bit.

Each round ends in a table in the shared folder; no round is computed twice.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import SCAN, Expr
from ..functions.kernels import evaluate
from ..functions.sql import UNBOUNDED, Over, needed, reach, stages
from ..session import stored
from ..sources.bars import KEYS, NUMBERS, TIME

#: Rows of a block.  The steepest mean, but that which keeps nothing, halves its memory each row: 2 ** -256 is still a number.
BLOCK_ROWS = 256
#: Rows before a part from which a branching recursion starts.
RUN_UP = 400
PART, OWN, DAY, BLOCK, ROW = "__part", "__own", "__day", "__block", "__row"
CARRIED = SCAN | UNBOUNDED
BRANCHING = {"psar", "psar_up", "supertrend", "supertrend_dir", "fisher", "utbot", "utbot_signal"}
_KEYS = ", ".join(KEYS)
_W = f"OVER (PARTITION BY {_KEYS}, {PART}, {BLOCK} ORDER BY {TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_BEFORE = f"OVER (PARTITION BY {_KEYS}, {PART}, {BLOCK} ORDER BY {TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def rounds(outputs: Iterable[Expr]) -> list[list[Expr]]:
    """The nodes that carry state below the outputs, by the number of such nodes that stand under them."""
    at: dict[Expr, int] = {}
    found: list[list[Expr]] = []
    for e in needed(outputs):
        at[e] = max((at[a] for a in e.args), default=0) + (e.op in CARRIED)
        if e.op in CARRIED:
            found += [[] for _ in range(at[e] - len(found))]
            found[at[e] - 1].append(e)
    return found


def over_columns(e: Expr, known: dict[Expr, Expr]) -> Expr:
    """e with the known nodes as columns; known gains what is built."""
    for x in needed([e]):
        if x not in known:
            known[x] = Expr(x.op, *(known[a] for a in x.args), p=x.p) if x.args else x
    return known[e]


class Scan:
    """Text for one affine node: its input columns are i{n}_0, i{n}_1, its local columns begin with its name."""

    def __init__(self, e: Expr, n: int):
        self.e, self.n, self.op = e, n, e.op
        self.x, self.y = f"i{n}_0", f"i{n}_1"
        self.k, self.g, self.l, self.p, self.s = (f"{c}{n}" for c in "kglps")
        self.gaps = e.op in ("ema", "ewm")
        self.mean = e.op in ("ema", "ewm", "wsma", "smooth")
        if self.mean:
            self.alpha = e.p[1] / e.p[0] if e.op == "smooth" else e.p[0]

    def mixed(self, y: str, x: str, gap: str) -> str:
        """The mean after x, which came `gap` rows without a value after y."""
        a, keep = repr(self.alpha), repr(1 - self.alpha)
        if self.gaps:
            w = f"pow({keep}D, {gap} + 1)"
            return f"(({w} * {y} + {a}D * {x}) / ({w} + {a}D))"
        if self.op == "smooth":
            n, m = self.e.p
            return f"(({float(m)!r}D * {x} + {float(n - m)!r}D * {y}) / {float(n)!r}D)"
        return f"({a}D * {x} + {keep}D * {y})"

    def local(self) -> list[dict[str, str]]:
        """Columns inside a block, in three stages."""
        x, k, g, log, p = self.x, self.k, self.g, self.l, self.p
        later = f"{x} IS NOT NULL AND {k} > 1"
        if self.mean:
            a, keep = repr(self.alpha), repr(1 - self.alpha)
            first = {k: f"count({x}) {_W}"}
            if self.alpha == 1:
                return [first, {p: f"CASE WHEN {k} > 1 THEN 0D ELSE 1D END"}, {self.s: f"CASE WHEN {k} > 1 THEN last_value({x}) IGNORE NULLS {_W} ELSE 0D END"}]
            if self.gaps:
                first[g] = f"{ROW} - 1 - max(CASE WHEN {x} IS NOT NULL THEN {ROW} END) {_BEFORE}"
                w = f"pow({keep}D, {g} + 1)"
                log = f"exp(coalesce(sum(CASE WHEN {later} THEN ln({w} / ({w} + {a}D)) END) {_W}, 0D))"
                added = f"{a}D * {x} / ({w} + {a}D)"
            else:
                log, added = f"pow({keep}D, greatest({k} - 1, 0))", f"{a}D * {x}"
            return [first, {p: log}, {self.s: f"{p} * coalesce(sum(CASE WHEN {later} THEN {added} / {p} END) {_W}, 0D)"}]
        match self.op:
            case "cumsum":
                return [{self.s: f"coalesce(sum({x}) {_W}, 0D)"}, {}, {}]
            case "masked":
                return [{k: f"count({x}) {_W}"}, {}, {}]
            case "rownum":
                return [{}, {}, {}]
            case "compound":
                f = f"(CASE WHEN {self.y} AND NOT ({PART} = 0 AND {BLOCK} = 0 AND {ROW} = 1) THEN 1D + {x} ELSE 1D END)"
                signed = f"CASE WHEN count_if({f} < 0) {_W} % 2 = 1 THEN -1D ELSE 1D END * exp(coalesce(sum(ln(nullif(abs({f}), 0D))) {_W}, 0D))"
                return [{p: f"CASE WHEN count_if({f} IS NULL) {_W} > 0 THEN NULL WHEN count_if({f} = 0) {_W} > 0 THEN 0D ELSE {signed} END"}, {}, {}]
            case "run":
                return [{k: f"max(CASE WHEN NOT {x} THEN {ROW} END) {_W}"}, {self.s: f"CAST({ROW} - coalesce({k}, 0) AS DOUBLE)"}, {}]
        raise AssertionError(self.op)

    def block(self) -> dict[str, str]:
        """What a block does to a state: one aggregate for each field."""
        x, n = self.x, self.n
        last = lambda c: f"max_by({c}, {TIME})"
        if self.mean:
            there = f"CASE WHEN {x} IS NOT NULL THEN {ROW} END"
            return {f"x{n}": f"min_by({x}, {TIME}) FILTER (WHERE {x} IS NOT NULL)", f"p{n}": last(self.p), f"s{n}": last(self.s), f"k{n}": f"count({x})", f"g{n}": f"min({there}) - 1", f"t{n}": f"count(*) - max({there})"}
        match self.op:
            case "cumsum":
                return {f"s{n}": f"coalesce(sum({x}), 0D)"}
            case "masked":
                return {f"s{n}": f"CAST(count({x}) AS DOUBLE)"}
            case "rownum":
                return {f"s{n}": "CAST(count(*) AS DOUBLE)"}
            case "compound":
                return {f"p{n}": last(self.p)}
            case "run":
                return {f"s{n}": last(self.s), f"p{n}": f"count({self.k}) = 0"}
        raise AssertionError(self.op)

    def carry(self) -> str:
        """An array with the state at the start of each of `blocks`."""
        n = self.n
        if self.mean:
            first = f"CASE WHEN b.k{n} = 0 THEN NULL WHEN a.y IS NULL THEN b.x{n} ELSE {self.mixed('a.y', f'b.x{n}', f'(a.g + b.g{n})')} END"
            zero = "named_struct('y', CAST(NULL AS DOUBLE), 'g', 0L, 'c', 0L, 'out', CAST(array() AS ARRAY<STRUCT<before: DOUBLE, first: DOUBLE, seen: BIGINT>>))"
            step = f"named_struct('y', CASE WHEN b.k{n} = 0 THEN a.y ELSE b.p{n} * {first} + b.s{n} END, 'g', CASE WHEN b.k{n} = 0 THEN a.g + b.n ELSE b.t{n} END, 'c', a.c + b.k{n}, 'out', array_append(a.out, named_struct('before', a.y, 'first', {first}, 'seen', a.c)))"
        else:
            start = repr(float(self.e.p[0])) if self.op == "compound" else "0.0"
            after = {"compound": f"a.y * b.p{n}", "run": f"b.s{n} + CASE WHEN b.p{n} THEN a.y ELSE 0D END"}.get(self.op, f"a.y + b.s{n}")
            zero = f"named_struct('y', {start}D, 'out', CAST(array() AS ARRAY<DOUBLE>))"
            step = f"named_struct('y', {after}, 'out', array_append(a.out, a.y))"
        return f"aggregate(blocks, {zero}, (a, b) -> {step}, a -> a.out)"

    def value(self) -> str:
        c, x = f"c{self.n}", self.x
        if self.mean:
            y = f"CASE WHEN {self.k} > 0 THEN {self.p} * {c}.first + {self.s} ELSE {c}.before END"
            least = self.e.p[1] if self.op == "ema" else 0
            return f"CASE WHEN {c}.seen + {self.k} >= {least} THEN {y} END" if least > 1 else y
        match self.op:
            case "cumsum":
                return f"CASE WHEN {x} IS NOT NULL THEN {c} + {self.s} END"
            case "masked":
                return f"CASE WHEN {c} + {self.k} > 1 THEN {x} END"
            case "rownum":
                return f"{c} + {ROW}"
            case "compound":
                return f"{c} * {self.p}"
            case "run":
                return f"{self.s} + CASE WHEN {self.k} IS NULL THEN {c} ELSE 0D END"
        raise AssertionError(self.op)


def scanned(rows: DataFrame, scans: list[Scan]) -> DataFrame:
    """rows, which have part, block and row in the block, with a column for each scan (its node's key)."""
    df = rows
    for stage in zip(*(s.local() for s in scans), strict=True):
        made = [f"{text} AS {name}" for each in stage for name, text in each.items()]
        if made:
            df = df.selectExpr("*", *made)
    local = stored(df, "blocks")
    fields = {name: text for s in scans for name, text in s.block().items()}
    blocks = local.groupBy(*KEYS, PART, BLOCK).agg(F.count("*").alias("n"), *[F.expr(text).alias(name) for name, text in fields.items()])
    # One row for each sequence: of every 256 bars some numbers.
    folded = blocks.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(PART, BLOCK, "n", *fields))).alias("blocks"))
    folded = folded.selectExpr(*KEYS, "blocks", *(f"{s.carry()} AS c{s.n}" for s in scans))
    starts = folded.selectExpr(*KEYS, f"inline(transform(sequence(0, size(blocks) - 1), p -> struct(blocks[p].{PART} AS {PART}, blocks[p].{BLOCK} AS {BLOCK}, {', '.join(f'c{s.n}[p] AS c{s.n}' for s in scans)})))")
    return local.join(stored(starts, "starts"), [*KEYS, PART, BLOCK]).selectExpr(*rows.columns, *(f"{s.value()} AS {s.e.key}" for s in scans))


def speculated(rows: DataFrame, places: DataFrame, outputs: dict[str, Expr], reads: list[str]) -> tuple[DataFrame, list[int]]:
    """(keys, time, outputs) of every row, and how many parts ran again in each repetition."""
    names, nodes = list(outputs), list(outputs.values())
    kept = T.StructType([*(rows.schema[k] for k in KEYS), T.StructField(PART, T.LongType()), rows.schema[TIME], *(T.StructField(n, T.DoubleType()) for n in names), T.StructField("began", T.BinaryType()), T.StructField("ended", T.BinaryType())])

    def told(held: list) -> bytes:
        return pickle.dumps([[float(v) for v in x] for x in held])

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by(TIME)
        own = table.column(OWN).to_numpy()
        start = table.column("began")[0].as_py() if "began" in table.column_names else None
        held = [list(x) for x in pickle.loads(start)] if start else []
        value = {c: table.column(c).to_numpy().astype(float) for c in reads}
        if not own.all():
            evaluate(nodes, {c: v[~own] for c, v in value.items()}, held)
        began = told(held) if held else b""
        got = evaluate(nodes, {c: v[own] for c, v in value.items()}, held)
        table = table.filter(pa.array(own))
        rest = [None] * (table.num_rows - 1)
        columns = [*(table.column(c) for c in (*KEYS, PART, TIME)), *(pa.array(v, from_pandas=True) for v in got), pa.array([began, *rest], pa.binary()), pa.array([told(held), *rest], pa.binary())]
        return pa.table(columns, names=[*KEYS, PART, TIME, *names, "began", "ended"])

    slim = rows.select(*KEYS, PART, TIME, *reads)
    with_past = slim.drop(PART).withColumn(DAY, F.date_trunc("day", TIME)).join(places, [*KEYS, DAY]).drop(DAY)
    done = stored(with_past.groupBy(*KEYS, PART).applyInArrow(kernel, kept), "speculated")
    again: list[int] = []
    while True:
        states = done.where("ended IS NOT NULL").select(*KEYS, PART, "began", "ended")
        # As many rows as parts.
        wrong = states.selectExpr(*KEYS, PART, "began", f"lag(ended) OVER (PARTITION BY {_KEYS} ORDER BY {PART}) AS before").where("before <> began")
        wrong = stored(wrong.select(*KEYS, PART, F.col("before").alias("began")), "unmet")
        if not (n := wrong.count()):
            return done.select(*KEYS, TIME, *names), again
        again.append(n)
        right = slim.join(wrong, [*KEYS, PART]).withColumn(OWN, F.lit(True)).groupBy(*KEYS, PART).applyInArrow(kernel, kept)
        done = stored(done.join(wrong.select(*KEYS, PART), [*KEYS, PART], "left_anti").unionByName(right), "speculated")


def compute_parts(bars: DataFrame, outputs: dict[str, Expr], rows: int, parts) -> DataFrame:
    """Keys, time and the outputs of every bar, all by parts of about `rows` rows; parts as `features.parts`."""
    turns = rounds(outputs.values())
    if turns:
        bars = stored(bars, "bars")
    known: dict[Expr, Expr] = {}
    wanted: list[dict[str, Expr]] = []
    scans: list[list[Scan]] = []
    branched: list[dict[str, Expr]] = []
    n = 0
    for nodes in turns:
        inputs, own, branches = {}, [], {}
        for e in nodes:
            over = [over_columns(a, known) for a in e.args]
            inputs |= {f"i{n}_{j}": a for j, a in enumerate(over)}
            if e.op in BRANCHING:
                branches[e.key] = Expr(e.op, *(Expr("column", p=(f"i{n}_{j}",)) for j in range(len(over))), p=e.p)
            else:
                own.append(Scan(e, n))
            n += 1
        known |= {e: Expr("column", p=(e.key, True) if e.inf else (e.key,)) for e in nodes}
        wanted.append(inputs)
        scans.append(own)
        branched.append(branches)
    final = {name: over_columns(e, known) for name, e in outputs.items()}
    back = max(b for each in (*wanted, final) for b in (reach(each) or {"": 1}).values())
    places = parts(bars, rows, max(back, RUN_UP if any(branched) else 1))
    width = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def framed(df: DataFrame, made: dict[str, Expr], carried: list[str], raw: set[str]) -> DataFrame:
        """The rows of every part with made, from them and the rows before that frames reach."""
        df = df.withColumn(DAY, F.date_trunc("day", TIME)).join(places, [*KEYS, DAY]).drop(DAY)
        # A fixed number: adaptive execution joins partitions by their bytes, and so few bytes under so many windows would be one task.
        df = df.repartition(width, *KEYS, PART)
        for items in stages(made, Over((*KEYS, PART), TIME), [*KEYS, PART, OWN, TIME, *carried], raw):
            df = df.selectExpr(*items)
        return df.where(OWN).drop(OWN)

    now, held = bars, []
    for inputs, own, branches in zip(wanted, scans, branched, strict=True):
        raw = {f"i{s.n}_0" for s in own if not s.gaps and s.op != "masked"}
        df = framed(now, inputs, [*NUMBERS, *held], raw)
        place = f"row_number() OVER (PARTITION BY {_KEYS}, {PART} ORDER BY {TIME}) - 1"
        df = df.selectExpr("*", f"{place} AS {ROW}").selectExpr(*df.columns, f"CAST(floor({ROW} / {BLOCK_ROWS}) AS BIGINT) AS {BLOCK}", f"{ROW} % {BLOCK_ROWS} + 1 AS {ROW}")
        if branches:
            df = stored(df, "inputs")
        made = scanned(df, own) if own else df
        if branches:
            reads = sorted({x.p[0] for e in branches.values() for x in e.args})
            made = made.join(speculated(df, places, branches, reads)[0], [*KEYS, TIME])
        held += [s.e.key for s in own] + list(branches)
        now = made.select(*KEYS, TIME, *NUMBERS, *held)
    return framed(now, final, [], set()).select(*KEYS, TIME, *outputs)
