"""Expressions as SQL text, in stages.

Spark SQL and other engines read the same text, so a plan can be checked against a
second engine.  Window expressions of one level stand in one SELECT: they share the
partitioning and the order, so all levels together need a single exchange and sort.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterable
from dataclasses import dataclass

from .expr import POINTWISE, WINDOW, Expr

INF = "CAST('Infinity' AS DOUBLE)"
_BINARY = {"add": "+", "sub": "-", "mul": "*", "lt": "<", "le": "<=", "gt": ">", "ge": ">=", "eq": "="}


@dataclass
class Over:
    keys: tuple[str, ...]
    time: str
    #: Which engine reads the text: they name functions over lists differently.
    spark: bool = True

    def rows(self, n: int | None = None) -> str:
        frame = "" if n is None else f" ROWS BETWEEN {'UNBOUNDED' if n == 0 else n - 1} PRECEDING AND CURRENT ROW"
        return f"OVER (PARTITION BY {', '.join(self.keys)} ORDER BY {self.time}{frame})"


def no_nan(e: Expr, text: str) -> str:
    return f"(CASE WHEN NOT isnan({text}) THEN {text} END)" if e.inf else text


def finite(e: Expr, text: str) -> str:
    return f"(CASE WHEN NOT isnan({text}) AND abs({text}) < {INF} THEN {text} END)" if e.inf else text


class Text:
    """Renders expressions; `ready` are those that are columns already."""

    def __init__(self, over: Over):
        self.over, self.ready = over, set()

    def point(self, e: Expr) -> str:
        if e in self.ready:
            return e.key
        if e.op == "column":
            return e.p[0]
        if e.op == "const":
            return f"CAST({e.p[0]!r} AS DOUBLE)"
        if e.op == "null":
            return "CAST(NULL AS DOUBLE)"
        if e.op not in POINTWISE:
            raise ValueError(f"{e.op} is not a column yet")
        a = [self.point(x) for x in e.args]
        if e.op in ("lt", "le", "gt", "ge", "eq", "ne"):
            a = [no_nan(x, t) for x, t in zip(e.args, a, strict=True)]
        match e.op:
            case "add" | "sub" | "mul":
                return f"({a[0]} {_BINARY[e.op]} {a[1]})"
            case "lt" | "le" | "gt" | "ge" | "eq":
                return f"coalesce({a[0]} {_BINARY[e.op]} {a[1]}, false)"
            case "ne":
                return f"coalesce({a[0]} <> {a[1]}, true)"
            case "div":
                return f"({a[0]} / nullif({a[1]}, 0))"
            case "ieee":
                return f"(CASE WHEN {a[1]} = 0 THEN CASE WHEN {a[0]} > 0 THEN {INF} WHEN {a[0]} < 0 THEN -{INF} END ELSE {a[0]} / nullif({a[1]}, 0) END)"
            case "neg":
                return f"(-{a[0]})"
            case "abs" | "sqrt" | "sign":
                return f"{e.op}({a[0]})"
            case "and" | "or":
                return f"({a[0]} {e.op} {a[1]})"
            case "where":
                return f"(CASE WHEN {a[0]} THEN {a[1]} ELSE {a[2]} END)"
            case "max2" | "min2":
                return f"(CASE WHEN {a[0]} IS NOT NULL AND {a[1]} IS NOT NULL THEN {'greatest' if e.op == 'max2' else 'least'}({a[0]}, {a[1]}) END)"
            case "maxskip":
                return f"greatest({', '.join(a)})"
            case "minskip":
                return f"least({', '.join(a)})"
            case "coalesce":
                return f"coalesce({a[0]}, {a[1]})"
            case "clip0":
                return f"(CASE WHEN {a[0]} IS NOT NULL THEN greatest({a[0]}, CAST(0 AS DOUBLE)) END)"
            case "number":
                return f"(CASE WHEN {a[0]} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
            case "nullzero":
                return f"nullif({a[0]}, 0)"
            case "finite":
                return finite(e.args[0], a[0])
        raise AssertionError(e.op)

    def summed(self, x: str, frame: str, term: str) -> str:
        """The sum of a term over the frame's values v and their places i, from 0, oldest first."""
        if self.over.spark:
            return f"aggregate(transform(array_agg({x}) {frame}, (v, i) -> {term}), CAST(0 AS DOUBLE), (s, v) -> s + v)"
        return f"list_sum(list_transform(array_agg({x}) {frame}, lambda v, j: {re.sub(r'\bi\b', '(j - 1)', term)}))"

    def window(self, e: Expr) -> str:
        n = e.p[0] if e.p else 0
        x = self.point(e.args[0]) if e.args else ""
        if e.op not in ("lag", "cumsum", "count") and e.args:
            x = finite(e.args[0], x)
        f = self.over.rows(n)
        full = f"CASE WHEN count({x}) {f} = {n} THEN"
        match e.op:
            case "lag":
                return f"lag({x}, {n}) {self.over.rows()}"
            case "avg" | "sum" | "max" | "min":
                return f"{full} {e.op}({x}) {f} END"
            case "std":
                return f"{full} CASE WHEN max({x}) {f} = min({x}) {f} THEN CAST(0 AS DOUBLE) ELSE stddev_pop({x}) {f} END END"
            case "stdraw":
                return f"{full} stddev_pop({x}) {f} END"
            case "stdsample":
                return f"{full} CASE WHEN max({x}) {f} = min({x}) {f} THEN CAST(0 AS DOUBLE) ELSE stddev_samp({x}) {f} END END"
            case "count":
                return f"CASE WHEN row_number() {self.over.rows()} >= {n} THEN sum(CASE WHEN {x} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) {f} END"
            case "cumsum":
                x = no_nan(e.args[0], x)
                return f"CASE WHEN {x} IS NOT NULL THEN sum({x}) {self.over.rows(0)} END"
            case "masked":
                return f"CASE WHEN count({x}) {self.over.rows(0)} > 1 THEN {x} END"
            case "rownum":
                return f"row_number() {self.over.rows()}"
            case "line":
                return f"{full} {self.summed(x, f, f'v * ({e.p[1]!r} + {e.p[2]!r} * i)')} END"
            case "weigh":
                weights = ", ".join(f"CAST({w!r} AS DOUBLE)" for w in e.p[1:])
                at = f"element_at(array({weights}), i + 1)" if self.over.spark else f"([{weights}])[i + 1]"
                return f"{full} {self.summed(x, f, f'v * {at}')} END"
            case "spread":
                return f"{full} {self.summed(x, f, f'abs(v - {self.point(e.args[1])})')} END"
            case "rank":
                return f"{full} {self.summed(x, f, f'CASE WHEN v < {x} THEN CAST(1 AS DOUBLE) WHEN v = {x} THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END')} + 0.5 END"
            case "since_max" | "since_min":
                best = self.point(e.args[1])
                place = f"array_position(array_agg({x}) {f}, {best})" if self.over.spark else f"list_position(array_agg({x}) {f}, {best})"
                return f"{full} CAST({n} - {place} AS DOUBLE) END"
        raise AssertionError(e.op)


def needed(outputs: Iterable[Expr]) -> list[Expr]:
    """All nodes below the outputs, arguments first."""
    seen: dict[Expr, None] = {}
    stack = [(e, False) for e in outputs]
    while stack:
        e, done = stack.pop()
        if done:
            seen[e] = None
        elif e not in seen:
            stack += [(e, True), *((a, False) for a in e.args if a not in seen)]
    return list(seen)


UNBOUNDED = {"cumsum", "masked", "rownum"}


def reach(outputs: dict[str, Expr]) -> dict[str, int | None]:
    """Rows back, this one included, that decide each output; None where all rows before do."""
    found: dict[Expr, int | None] = {}
    for e in needed(outputs.values()):
        below = [found[a] for a in e.args]
        if e.scan or e.op in UNBOUNDED or None in below:
            found[e] = None
        else:
            own = e.p[0] if e.op == "lag" else e.p[0] - 1 if e.p and e.op in WINDOW else 0
            found[e] = max(below, default=1) + int(own)
    return {name: found[e] for name, e in outputs.items()}


def stages(outputs: dict[str, Expr], over: Over, carried: list[str], raw: Collection[str] = ()) -> list[list[str]]:
    """SELECT lists, each over the one before, that end in `carried` and the outputs.

    A column is carried only as long as a later stage reads it.  Infinities end as NULL,
    but in the outputs named in `raw`.
    """
    if any(e.scan for e in outputs.values()):
        raise ValueError("scans are not SQL")
    nodes = needed(outputs.values())
    uses: dict[Expr, int] = {}
    for e in nodes:
        for a in e.args:
            uses[a] = uses.get(a, 0) + 1
    inner = {e for e in nodes if e.op in POINTWISE and uses.get(e, 0) > 1}
    columns = sorted({e.p[0] for e in nodes if e.op == "column"} - set(carried))
    text, out, top = Text(over), [], max((e.level for e in nodes), default=0)
    stored: list[Expr] = []
    for level in range(top + 1):
        new = [e for e in nodes if e.level == level and e.op not in POINTWISE and e.args]
        if new:
            made = [f"{text.window(e)} AS {e.key}" for e in new]
            out.append([*carried, *columns, *(e.key for e in stored), *made])
            stored += new
            text.ready.update(new)
        shared = [e for e in nodes if e in inner and e.level == level]
        made = [f"{text.point(e)} AS {e.key}" for e in shared]
        later = [e for e in nodes if e.level > level]
        reads = {a for e in later for a in _leaves(e, text.ready | set(shared))} | {a for e in outputs.values() for a in _leaves(e, text.ready | set(shared), own=True)}
        stored = [e for e in stored if e in reads]
        out.append([*carried, *columns, *(e.key for e in stored), *(m for e, m in zip(shared, made, strict=True) if e in reads)])
        stored += [e for e in shared if e in reads]
        text.ready.update(e for e in shared if e in reads)
    out.append([*carried, *(f"{(no_nan if name in raw else finite)(e, text.point(e))} AS {name}" for name, e in outputs.items())])
    return out


def _leaves(e: Expr, ready: set[Expr], own: bool = False) -> set[Expr]:
    """The stored expressions that e is rendered from."""
    found, stack = set(), [e] if own else list(e.args)
    while stack:
        x = stack.pop()
        if x in ready:
            found.add(x)
        elif x.op in POINTWISE:
            stack += x.args
    return found


def query(outputs: dict[str, Expr], over: Over, carried: list[str], source: str) -> str:
    """One nested SELECT over the relation `source`."""
    text = source
    for i, items in enumerate(stages(outputs, over, carried)):
        text = f"(SELECT {', '.join(items)} FROM {text}{f' s{i}' if i else ' s'})"
    return text
