"""Recursions over one ordered sequence, and the expressions built on them.

Every function takes and gives float64 arrays of one sequence in time order; missing is
NaN.  A recursion goes on from `held`, its state after the rows before (empty: none), and
leaves its own there.  `evaluate` computes expressions from the bar columns, scans and what stands on
them included; a job calls it once for each sequence, or once for many that stand one behind
the other (`Abreast`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from itertools import pairwise

import numpy as np

from .expr import Expr
from .sql import needed

NAN = float("nan")


def _keep(held: list | None, *values: float) -> None:
    if held is not None:
        held[:] = values


def ewm(x: np.ndarray, alpha: float, least: int = 0, held: list | None = None) -> np.ndarray:
    """Exponential mean, seeded by the first value; a gap lowers the weight of what was before."""
    y, weight, seen = held or (NAN, 1.0, 0)
    out = []
    for v in np.where(np.isinf(x), NAN, x).tolist():
        if seen:
            weight *= 1 - alpha
            if v == v:
                if v != y:
                    y = (weight * y + alpha * v) / (weight + alpha)
                weight, seen = 1.0, seen + 1
        elif v == v:
            y, seen = v, 1
        out.append(y if seen >= least else NAN)
    _keep(held, y, weight, seen)
    return np.array(out)


def wsma(x: np.ndarray, alpha: float, held: list | None = None) -> np.ndarray:
    """alpha * value + (1 - alpha) * before; a missing value repeats what was before."""
    out, y = [], held[0] if held else NAN
    for v in x.tolist():
        if v == v:
            y = v if y != y else alpha * v + (1 - alpha) * y
        out.append(y)
    _keep(held, y)
    return np.array(out)


def smooth(x: np.ndarray, n: int, m: int, held: list | None = None) -> np.ndarray:
    """(m * value + (n - m) * before) / n; a missing value repeats what was before."""
    out, y = [], held[0] if held else NAN
    for v in x.tolist():
        if v == v:
            y = v if y != y else (m * v + (n - m) * y) / n
        out.append(y)
    _keep(held, y)
    return np.array(out)


def psar(high: np.ndarray, low: np.ndarray, close: np.ndarray, step: float, most: float, *, up: bool, held: list | None = None) -> np.ndarray:
    """Parabolic stop.  up: always begin upwards, else on the side of the first close."""
    h, l, out = high.tolist(), low.tolist(), []
    if not h:
        return np.zeros(0)
    if held:
        rising, best, stop, pace, h2, h1, l2, l1 = held
    else:
        rising = up or close[0] >= (h[0] + l[0]) / 2
        best, stop = (h[0], l[0]) if rising else (l[0], h[0])
        pace, h2, h1, l2, l1 = step, h[0], h[0], l[0], l[0]
        out.append(stop)
    for now, least in zip(h[len(out) :], l[len(out) :], strict=True):
        if now == now and least == least:
            stop += pace * (best - stop)
            if rising:
                stop = min(stop, l1, l2)
                turned, further = least < stop, now > best
            else:
                stop = max(stop, h1, h2)
                turned, further = now > stop, least < best
            if turned:
                stop, rising, pace = best, not rising, step
                best = now if rising else least
            elif further:
                best = now if rising else least
                pace = min(pace + step, most)
        out.append(stop)
        h2, h1, l2, l1 = h1, now, l1, least
    _keep(held, rising, best, stop, pace, h2, h1, l2, l1)
    return np.array(out)


def supertrend(high: np.ndarray, low: np.ndarray, close: np.ndarray, atr: np.ndarray, times: float, held: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Line and direction of the ratcheting bands around the middle price."""
    mid = (high + low) / 2
    line, way = [], []
    before = list(held) if held else None
    for top, bottom, c in zip((mid + times * atr).tolist(), (mid - times * atr).tolist(), close.tolist(), strict=True):
        if before is None:
            u, d, at, side = top, bottom, top, 1.0
        else:
            u0, d0, at, c0 = before
            u = top if top < u0 or c0 > u0 else u0
            d = bottom if bottom > d0 or c0 < d0 else d0
            at = (d if c > u else u) if at == u0 else (u if c < d else d)
            side = 1.0 if at == d else -1.0
        line.append(at)
        way.append(side)
        before = u, d, at, c
    if before:
        _keep(held, *before)
    return np.array(line), np.array(way)


def fisher(close: np.ndarray, top: np.ndarray, bottom: np.ndarray, held: list | None = None) -> np.ndarray:
    """Fisher transform of the place in the range; a flat range gives nothing and keeps the state."""
    value, line = held or (0.0, 0.0)
    out = []
    for c, h, l in zip(close.tolist(), top.tolist(), bottom.tolist(), strict=True):
        if h != h or h == l:
            out.append(NAN)
            continue
        value = max(-0.999, min(0.999, 0.66 * ((c - l) / (h - l) - 0.5) + 0.67 * value))
        line = 0.5 * math.log((1 + value) / (1 - value)) + 0.5 * line
        out.append(line)
    _keep(held, value, line)
    return np.array(out)


def utbot(close: np.ndarray, atr: np.ndarray, held: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Trailing stop and the signal of its crossing."""
    raw, c0, begun = held or (NAN, NAN, 0)
    stop, signal = [], []
    for c, a in zip(close.tolist(), atr.tolist(), strict=True):
        s0, before = (0.0 if raw != raw else raw), raw
        if c > s0 and c0 > s0:
            raw = max(s0, c - a)
        elif c < s0 and c0 < s0:
            raw = min(s0, c + a)
        else:
            raw = c - a if c > s0 else c + a
        signal.append(0.0 if not begun else 1.0 if c > raw and c0 <= before else -1.0 if c < raw and c0 >= before else 0.0)
        stop.append(raw)
        c0, begun = c, 1
    _keep(held, raw, c0, begun)
    return np.array(stop), np.array(signal)


def compound(rate: np.ndarray, when: np.ndarray, seed: float, held: list | None = None) -> np.ndarray:
    """seed, times 1 + rate in the rows where `when` holds."""
    grown = np.where(when, 1 + rate, 1.0)
    if not held:
        grown[:1] = 1.0
    grown = np.cumprod(np.concatenate([held or [1.0], grown]))
    _keep(held, grown[-1])
    return seed * grown[1:]


def run(when: np.ndarray, held: list | None = None) -> np.ndarray:
    """Rows in a row for which `when` holds."""
    at = np.arange(len(when))
    broken = np.maximum.accumulate(np.where(when, -1, at)) if len(when) else at
    out = (at - broken + np.where(broken < 0, held[0] if held else 0, 0)).astype(float)
    if len(out):
        _keep(held, out[-1])
    return out


def windows(x: np.ndarray, n: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(x, n)


def framed(x: np.ndarray, n: int, fn, chunk: int = 20_000) -> np.ndarray:
    """fn over every trailing frame of n values; missing where one of them is."""
    x = np.where(np.isinf(x), NAN, x)
    out = np.full(len(x), NAN)
    for i in range(0, len(x) - n + 1, chunk):
        w = windows(x[i : i + chunk + n - 1], n)
        out[i + n - 1 : i + n - 1 + len(w)] = fn(w)
    return out


def _summed(x: np.ndarray, n: int) -> np.ndarray:
    """The sum of every n values in a row, oldest first."""
    out = x[: len(x) - n + 1].copy()
    for i in range(1, n):
        out += x[i : i + len(out)]
    return out


def _extreme(x: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """The best of every n values in a row, from those of 1, 2, 4, ... in a row."""
    got, w = x, 1
    while w < n:
        step = min(w, n - w)
        got, w = best(got[: len(got) - step], got[step:]), w + step
    return got


#: Frames that are made from whole columns, not one by one.
_WHOLE = {"avg": lambda x, n: _summed(x, n) / n, "sum": _summed, "max": lambda x, n: _extreme(x, n, np.maximum), "min": lambda x, n: _extreme(x, n, np.minimum)}


def _std(ddof: int, constant: bool):
    def fn(w: np.ndarray) -> np.ndarray:
        s = w.std(axis=1, ddof=ddof)
        return np.where(w.max(axis=1) == w.min(axis=1), 0.0, s) if constant else s

    return fn


_FRAMES = {"std": _std(0, True), "stdraw": _std(0, False), "stdsample": _std(1, True)}


def _weighted(e: Expr) -> np.ndarray:
    return e.p[1] + e.p[2] * np.arange(e.p[0]) if e.op == "line" else np.array(e.p[1:])


#: Sums over frames whose order counts, of the expression and the frames' values.
_ORDERED = {
    "line": lambda e, w: w @ _weighted(e), "weigh": lambda e, w: w @ _weighted(e), "spread": lambda e, w: np.abs(w - w.mean(axis=1)[:, None]).sum(axis=1),
    "rank": lambda e, w: (w < w[:, -1:]).sum(axis=1) + (w == w[:, -1:]).sum(axis=1) / 2 + 0.5,
    "since_max": lambda e, w: e.p[0] - 1.0 - w.argmax(axis=1), "since_min": lambda e, w: e.p[0] - 1.0 - w.argmin(axis=1),
}


def _window(e: Expr, x: np.ndarray, held: list) -> np.ndarray:
    n = e.p[0] if e.p else 0
    if e.op == "cumsum":
        gone = np.isnan(x)
        sums = np.cumsum(np.concatenate([held or [0.0], np.where(gone, 0.0, x)]))
        _keep(held, sums[-1])
        return np.where(gone, NAN, sums[1:])
    if e.op == "masked":
        out, there = x.copy(), np.flatnonzero(~np.isnan(x))[:1]
        if not held and len(there):
            out[there] = NAN
            _keep(held, 1.0)
        return out
    back = n if e.op == "lag" else n - 1
    rows = np.concatenate([held or [NAN] * back, x.astype(float)])
    held[:] = rows[len(rows) - back :].tolist()
    if e.op == "lag":
        return rows[: len(x)]
    if e.op in _ORDERED:
        return framed(rows, n, lambda w: np.where(np.isnan(w).any(axis=1), NAN, _ORDERED[e.op](e, w)))[back:]
    if e.op in _FRAMES:
        return framed(rows, n, _FRAMES[e.op])[back:]
    out = np.full(len(rows), NAN)
    if len(rows) >= n:
        out[back:] = _WHOLE["sum" if e.op == "count" else e.op](np.where(np.isinf(rows), NAN, rows), n)
    return out[back:]


_POINT = {
    "add": np.add, "sub": np.subtract, "mul": np.multiply, "ieee": np.divide, "neg": np.negative, "abs": np.abs, "sqrt": np.sqrt, "sign": np.sign,
    "lt": np.less, "le": np.less_equal, "gt": np.greater, "ge": np.greater_equal, "eq": np.equal, "ne": np.not_equal, "and": np.logical_and, "or": np.logical_or,
    "where": np.where, "max2": np.maximum, "min2": np.minimum, "coalesce": lambda a, b: np.where(np.isnan(a), b, a), "clip0": lambda x: np.maximum(x, 0.0),
    "number": lambda c: c.astype(float), "nullzero": lambda x: np.where(x == 0, NAN, x), "finite": lambda x: np.where(np.isinf(x), NAN, x),
    "div": lambda a, b: np.divide(a, np.where(b == 0, NAN, b)), "maxskip": lambda *a: np.fmax.reduce(np.broadcast_arrays(*a)), "minskip": lambda *a: np.fmin.reduce(np.broadcast_arrays(*a)),
}


def _scan(e: Expr, a: list[np.ndarray], held: list) -> np.ndarray:
    match e.op:
        case "ema":
            return ewm(a[0], *e.p, held=held)
        case "ewm":
            return ewm(a[0], e.p[0], held=held)
        case "wsma":
            return wsma(a[0], e.p[0], held)
        case "smooth":
            return smooth(a[0], *e.p, held)
        case "psar" | "psar_up":
            return psar(*a, *e.p, up=e.op == "psar_up", held=held)
        case "supertrend" | "supertrend_dir":
            return supertrend(*a, *e.p, held)[e.op == "supertrend_dir"]
        case "fisher":
            return fisher(*a, held)
        case "utbot" | "utbot_signal":
            return utbot(*a, held)[e.op == "utbot_signal"]
        case "compound":
            return compound(a[0], a[1].astype(bool), e.p[0], held)
        case "run":
            return run(a[0].astype(bool), held)
    raise AssertionError(e.op)


class Abreast:
    """Sequences that stand one behind the other; begins: where each one does.

    A mean goes through all of them at once, by their first rows, their second rows, and so
    on, as long as there are enough; each has the values it has alone, bit for bit.
    """

    #: Fewer sequences than this go on one by one.
    LEAST = 12

    def __init__(self, begins: np.ndarray, rows: int):
        self.ends, lengths = np.append(begins[1:], rows), np.diff(np.append(begins, rows))
        self.begins, self.place = begins, np.arange(rows) - np.repeat(begins, lengths)
        self.rank = np.empty(len(begins), int)
        self.rank[np.argsort(-lengths, kind="stable")] = np.arange(len(begins))
        many = np.bincount(self.place)
        cuts = np.append(0, np.cumsum(many))
        self.steps = int((many >= self.LEAST).sum())
        self.cuts = cuts[: self.steps + 1].tolist()
        #: Where a row is in the order of steps, and which row is there.
        self.spot = cuts[self.place] + np.repeat(self.rank, lengths)
        self.row = np.empty(rows, int)
        self.row[self.spot] = np.arange(rows)

    def each(self, fn: Callable, *a: np.ndarray) -> np.ndarray:
        """fn of every sequence by itself."""
        return np.concatenate([fn(*(x[i:j] for x in a)) for i, j in zip(self.begins, self.ends, strict=True)])

    def seen(self, x: np.ndarray) -> np.ndarray:
        """Values so far in the own sequence."""
        there = np.cumsum(~np.isnan(x))
        return there - np.repeat(there[self.begins] - ~np.isnan(x[self.begins]), self.ends - self.begins)

    def mean(self, e: Expr, x: np.ndarray) -> np.ndarray:
        if e.op in ("ema", "ewm"):
            x = np.where(np.isinf(x), NAN, x)
        seen = self.seen(x)
        if (np.isnan(x) & (seen > 0)).any():  # a gap
            return self.each(lambda v: _scan(e, [v], []), x)
        match e.op:
            case "ema" | "ewm":
                alpha, alone = e.p[0], lambda v, y: ewm(v, e.p[0], held=[y, 1.0, 1])
                keep = 1 - alpha
                step = lambda v, y: np.where((v == y) | (y != y), v, (keep * y + alpha * v) / (keep + alpha))
            case "wsma":
                alpha, alone = e.p[0], lambda v, y: wsma(v, e.p[0], [y])
                step = lambda v, y: np.where(y != y, v, alpha * v + (1 - alpha) * y)
            case "smooth":
                (n, m), alone = e.p, lambda v, y: smooth(v, *e.p, [y])
                step = lambda v, y: np.where(y != y, v, (m * v + (n - m) * y) / n)
        values, out = x[self.row], np.empty(len(x))
        y = np.full(len(self.begins), NAN)
        for a, b in pairwise(self.cuts):
            y = out[a:b] = step(values[a:b], y[: b - a])
        out = out[self.spot]
        for i in np.flatnonzero(self.ends - self.begins > self.steps):
            a, b = self.begins[i] + self.steps, self.ends[i]
            last = out[a - 1] if self.steps else NAN
            out[a:b] = alone(x[a:b], float(last)) if last == last else _scan(Expr("ewm", *e.args, p=e.p[:1]) if e.op == "ema" else e, [x[a:b]], [])
        return np.where(seen >= e.p[1], out, NAN) if e.op == "ema" else out

    def window(self, e: Expr, x: np.ndarray) -> np.ndarray:
        if e.op in ("cumsum", "masked"):
            return self.each(lambda v: _window(e, v, []), x)
        return np.where(self.place < (e.p[0] if e.op == "lag" else e.p[0] - 1), NAN, _window(e, x, []))

    def scan(self, e: Expr, a: list[np.ndarray]) -> np.ndarray:
        if e.op in ("ema", "ewm", "wsma", "smooth"):
            return self.mean(e, a[0])
        return self.each(lambda *v: _scan(e, list(v), []), *a)


def evaluate(outputs: Iterable[Expr], bars: dict[str, np.ndarray], held: list[list[float]] | None = None, begins: np.ndarray | None = None) -> list[np.ndarray]:
    """Each output over the bars of one sequence; infinities become missing at the end.

    With `begins`, the rows at which they begin, bars are many whole sequences, and nothing
    is held.

    An intermediate result is dropped after its last use.  `held` carries a sequence from
    call to call: it begins empty, and each call leaves in it what the next rows need (one
    list for each node, of the last rows of a frame or the state of a recursion), so that
    a sequence given in parts has the values of the whole.
    """
    outputs = list(outputs)
    nodes = needed(outputs)
    n = len(next(iter(bars.values())))
    abreast = None if begins is None or not n else Abreast(begins, n)
    held = [] if held is None else held
    held += [[] for _ in nodes[len(held) :]]
    left: dict[Expr, int] = {}
    for e in nodes:
        for x in e.args:
            left[x] = left.get(x, 0) + 1
    for e in outputs:
        left[e] = left.get(e, 0) + 1
    value: dict[Expr, np.ndarray] = {}
    with np.errstate(all="ignore"):
        for e, state in zip(nodes, held, strict=True):
            a = [value[x] for x in e.args]
            if e.op == "column":
                got = bars[e.p[0]]
            elif e.op in ("const", "null"):
                got = np.full(n, e.p[0] if e.p else NAN)
            elif e.op in _POINT:
                got = _POINT[e.op](*a)
            elif e.op in {"lag", "count", "cumsum", "masked", *_ORDERED, *_FRAMES, *_WHOLE}:
                got = abreast.window(e, a[0].astype(float)) if abreast else _window(e, a[0], state)
            else:
                got = abreast.scan(e, a) if abreast else _scan(e, a, state)
            value[e] = got
            for x in e.args:
                left[x] -= 1
                if not left[x]:
                    value.pop(x, None)
        return [np.where(np.isinf(value[e]), NAN, value[e]).astype(float) for e in outputs]
