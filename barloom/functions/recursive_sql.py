"""Recursive columns as SQL with WITH RECURSIVE, for a second engine to check them.

A recursion keeps named states.  `_STATES` gives, for each kind, the states' first and
next values and the output, as text over `{x0}`, `{x1}` (the arguments in this row) and
`{name}` (a state: in the row before, or in this row for the output).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from .expr import POINTWISE, Expr
from .sql import Over, Text, finite, needed, no_nan


def _ewm(alpha: float, least: int) -> tuple[dict, str]:
    a, keep = repr(alpha), repr(1 - alpha)
    mixed = f"(({{w}} * {keep}) * {{y}} + {a} * {{x0}}) / (({{w}} * {keep}) + {a})"
    return {
        "y": ("{x0}", f"CASE WHEN {{x0}} IS NULL OR {{x0}} = {{y}} THEN {{y}} WHEN {{y}} IS NULL THEN {{x0}} ELSE {mixed} END"),
        "w": ("1e0", f"CASE WHEN {{x0}} IS NULL AND {{y}} IS NOT NULL THEN {{w}} * {keep} ELSE 1e0 END"),
        "c": ("CASE WHEN {x0} IS NULL THEN 0 ELSE 1 END", "{c} + CASE WHEN {x0} IS NULL THEN 0 ELSE 1 END"),
    }, f"CASE WHEN {{c}} >= {max(least, 1)} THEN {{y}} END"


def _mean(next_value: str) -> tuple[dict, str]:
    return {"y": ("{x0}", f"CASE WHEN {{x0}} IS NULL THEN {{y}} WHEN {{y}} IS NULL THEN {{x0}} ELSE {next_value} END")}, "{y}"


def _psar(step: float, most: float, up: bool) -> tuple[dict, str]:
    rising = "true" if up else "{x2} >= ({x0} + {x1}) / 2"
    pulled = "({s} + {a} * ({b} - {s}))"
    # In a rising row the stop stays below the two lows before, in a falling one above the highs.
    stop = f"(CASE WHEN {{r}} THEN least({pulled}, {{l1}}, {{l2}}) ELSE greatest({pulled}, {{h1}}, {{h2}}) END)"
    turned = f"(CASE WHEN {{r}} THEN {{x1}} < {stop} ELSE {{x0}} > {stop} END)"
    further = "(CASE WHEN {r} THEN {x0} > {b} ELSE {x1} < {b} END)"
    return {
        "r": (rising, f"CASE WHEN {turned} THEN NOT {{r}} ELSE {{r}} END"),
        "b": (f"CASE WHEN {rising} THEN {{x0}} ELSE {{x1}} END", f"CASE WHEN {turned} THEN CASE WHEN {{r}} THEN {{x1}} ELSE {{x0}} END WHEN {further} THEN CASE WHEN {{r}} THEN {{x0}} ELSE {{x1}} END ELSE {{b}} END"),
        "s": (f"CASE WHEN {rising} THEN {{x1}} ELSE {{x0}} END", f"CASE WHEN {turned} THEN {{b}} ELSE {stop} END"),
        "a": (f"{step!r}", f"CASE WHEN {turned} THEN {step!r} WHEN {further} THEN least({{a}} + {step!r}, {most!r}) ELSE {{a}} END"),
        "l1": ("{x1}", "{x1}"), "l2": ("{x1}", "{l1}"), "h1": ("{x0}", "{x0}"), "h2": ("{x0}", "{h1}"),
    }, "{s}"


def _supertrend(times: float, way: bool) -> tuple[dict, str]:
    up, down = f"(({{x0}} + {{x1}}) / 2 + {times!r} * {{x3}})", f"(({{x0}} + {{x1}}) / 2 - {times!r} * {{x3}})"
    u = f"(CASE WHEN {up} < {{u}} OR {{c}} > {{u}} THEN {up} ELSE {{u}} END)"
    d = f"(CASE WHEN {down} > {{d}} OR {{c}} < {{d}} THEN {down} ELSE {{d}} END)"
    line = f"(CASE WHEN {{t}} = {{u}} THEN CASE WHEN {{x2}} > {u} THEN {d} ELSE {u} END ELSE CASE WHEN {{x2}} < {d} THEN {u} ELSE {d} END END)"
    return {"u": (up, u), "d": (down, d), "t": (up, line), "c": ("{x2}", "{x2}"), "k": ("1e0", f"CASE WHEN {line} = {d} THEN 1e0 ELSE -1e0 END")}, "{k}" if way else "{t}"


def _fisher() -> tuple[dict, str]:
    flat = "({x1} IS NULL OR {x1} = {x2})"
    place = "greatest(-0.999e0, least(0.999e0, 0.66e0 * (({x0} - {x2}) / nullif({x1} - {x2}, 0) - 0.5e0) + 0.67e0 * %s))"
    turn = "0.5e0 * ln((1 + %s) / (1 - %s)) + 0.5e0 * %s"
    first, later = place % "0e0", place % "{v}"
    return {
        "v": (f"CASE WHEN {flat} THEN 0e0 ELSE {first} END", f"CASE WHEN {flat} THEN {{v}} ELSE {later} END"),
        "f": (f"CASE WHEN {flat} THEN 0e0 ELSE {turn % (first, first, '0e0')} END", f"CASE WHEN {flat} THEN {{f}} ELSE {turn % (later, later, '{f}')} END"),
        "o": (f"NOT {flat}", f"NOT {flat}"),
    }, "CASE WHEN {o} THEN {f} END"


def _utbot(signal: bool) -> tuple[dict, str]:
    s = "coalesce({r}, 0e0)"
    stop = f"(CASE WHEN {{x0}} > {s} AND {{c}} > {s} THEN greatest({s}, {{x0}} - {{x1}}) WHEN {{x0}} < {s} AND {{c}} < {s} THEN least({s}, {{x0}} + {{x1}}) WHEN {{x0}} > {s} THEN {{x0}} - {{x1}} ELSE {{x0}} + {{x1}} END)"
    return {
        "r": ("CASE WHEN {x0} > 0 THEN {x0} - {x1} ELSE {x0} + {x1} END", stop),
        "g": ("0e0", f"CASE WHEN {{x0}} > {stop} AND {{c}} <= {{r}} THEN 1e0 WHEN {{x0}} < {stop} AND {{c}} >= {{r}} THEN -1e0 ELSE 0e0 END"),
        "c": ("{x0}", "{x0}"),
    }, "{g}" if signal else "{r}"


_STATES: dict[str, Callable[..., tuple[dict, str]]] = {
    "ema": _ewm,
    "ewm": lambda alpha: _ewm(alpha, 1),
    "wsma": lambda alpha: _mean(f"{alpha!r} * {{x0}} + {(1 - alpha)!r} * {{y}}"),
    "smooth": lambda n, m: _mean(f"({float(m)!r} * {{x0}} + {float(n - m)!r} * {{y}}) / {float(n)!r}"),
    "psar": lambda step, most: _psar(step, most, False),
    "psar_up": lambda step, most: _psar(step, most, True),
    "supertrend": lambda times: _supertrend(times, False),
    "supertrend_dir": lambda times: _supertrend(times, True),
    "fisher": _fisher,
    "utbot": lambda: _utbot(False),
    "utbot_signal": lambda: _utbot(True),
    "compound": lambda seed: ({"y": (f"CAST({seed!r} AS DOUBLE)", "{y} * CASE WHEN {x1} THEN 1 + {x0} ELSE 1e0 END")}, "{y}"),
    "run": lambda: ({"y": ("CASE WHEN {x0} THEN 1e0 ELSE 0e0 END", "CASE WHEN {x0} THEN {y} + 1 ELSE 0e0 END")}, "{y}"),
}


def _fill(text: str, inputs: list[str], state: str) -> str:
    return re.sub(r"\{(\w+)\}", lambda m: inputs[int(m[1][1:])] if re.fullmatch(r"x\d", m[1]) else f"{state}{m[1]}", text)


def query(outputs: dict[str, Expr], over: Over, carried: list[str], source: str) -> str:
    """SELECT carried and the outputs, recursions included, as a chain of WITH RECURSIVE steps."""
    nodes = needed(outputs.values())
    columns = sorted({e.p[0] for e in nodes if e.op == "column"} - set(carried))
    keys, text = list(over.keys), Text(over)
    parts = [f"t0 AS MATERIALIZED (SELECT {', '.join([*carried, *columns])}, row_number() {over.rows()} AS n_ FROM {source} s)"]
    stored: list[str] = []
    last = "t0"
    for level in range(max((e.level for e in nodes), default=0) + 1):
        new = [e for e in nodes if e.level == level and e.op not in POINTWISE and e.args]
        windows, scans = [e for e in new if e.op not in _STATES], [e for e in new if e.op in _STATES]
        # What a recursion reads must be a column.
        reads = [a for e in scans for a in e.args if a not in text.ready and a.op != "column"]
        reads = list(dict.fromkeys(reads))
        if windows or reads:
            made = [f"{text.window(e)} AS {e.key}" for e in windows]
            made += [f"{text.point(a)} AS {a.key}" for a in reads]
            name = f"t{len(parts)}"
            parts.append(f"{name} AS MATERIALIZED (SELECT *, {', '.join(made)} FROM {last})")
            last = name
            text.ready.update([*windows, *reads])
            stored += [e.key for e in (*windows, *reads)]
        if scans:
            first, later, given = [], [], []
            for e in scans:
                states, out = _STATES[e.op](*e.p)
                # Exponential means take an infinity for a gap, the other recursions keep it.
                clean = finite if e.op in ("ema", "ewm") else no_nan
                inputs = [clean(a, f"b.{a.key if a in text.ready else a.p[0]}") for a in e.args]
                for s, (x, y) in states.items():
                    first.append(f"{_fill(x, inputs, '')} AS {e.key}_{s}")
                    later.append(f"{_fill(y, inputs, f'e.{e.key}_')}")
                given.append(f"{_fill(out, inputs, f'e.{e.key}_')} AS {e.key}")
            on = " AND ".join(f"b.{k} = e.{k}" for k in keys)
            loop, name = f"r{len(parts)}", f"t{len(parts) + 1}"
            parts.append(f"{loop} AS (SELECT {', '.join(f'b.{k}' for k in keys)}, b.n_, {', '.join(first)} FROM {last} b WHERE n_ = 1 UNION ALL SELECT {', '.join(f'b.{k}' for k in keys)}, b.n_, {', '.join(later)} FROM {loop} e JOIN {last} b ON {on} AND b.n_ = e.n_ + 1)")
            parts.append(f"{name} AS MATERIALIZED (SELECT b.*, {', '.join(given)} FROM {last} b JOIN {loop} e ON {on} AND b.n_ = e.n_)")
            last = name
            text.ready.update(scans)
            stored += [e.key for e in scans]
    final = ", ".join([*carried, *(f"{finite(e, text.point(e))} AS {name}" for name, e in outputs.items())])
    return f"WITH RECURSIVE {', '.join(parts)} SELECT {final} FROM {last}"
