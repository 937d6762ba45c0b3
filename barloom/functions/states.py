"""What a sequence needs to go on: for each node of the graph that has a past, its numbers.

Numbers are kept under the node's signature, a digest of its formula, so that they find
their node again whatever other columns are asked for, and in whatever order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from .expr import SCAN, WINDOW, Expr
from .kernels import evaluate
from .sql import needed

_signatures: dict[Expr, str] = {}


class MissingState(ValueError):
    """A column needs a past that was not kept."""


def signature(e: Expr) -> str:
    for x in needed([e]):
        if x not in _signatures:
            text = "|".join([x.op, *map(repr, x.p), *(_signatures[a] for a in x.args)])
            _signatures[x] = hashlib.sha256(text.encode()).hexdigest()[:16]
    return _signatures[e]


def past(outputs: Iterable[Expr]) -> list[Expr]:
    """The nodes below the outputs that keep something from row to row."""
    return [e for e in needed(outputs) if e.args and (e.op in WINDOW or e.op in SCAN)]


def step(outputs: dict[str, Expr], bars: dict, kept: dict[str, list[float]] | None) -> tuple[list, dict[str, list[float]]]:
    """The outputs' values over bars that follow those of `kept`, and what is kept then.

    kept: numbers by signature, None for a sequence that begins here.  What other columns
    kept stays as it was and is stale from now on, so it is dropped.  A column whose nodes
    are not in kept raises MissingState.
    """
    nodes = needed(outputs.values())
    stateful = set(past(outputs.values()))
    if kept is not None:
        lacking = {e for e in stateful if signature(e) not in kept}
        if lacking:
            names = [n for n, e in outputs.items() if lacking & set(needed([e]))]
            raise MissingState(f"no past was kept for {', '.join(names[:5])}{' and others' if len(names) > 5 else ''}; fill it from history")
    held = [list(kept[signature(e)]) if kept is not None and e in stateful else [] for e in nodes]
    values = evaluate(outputs.values(), bars, held)
    return values, {signature(e): [float(v) for v in h] for e, h in zip(nodes, held, strict=True) if e in stateful}
