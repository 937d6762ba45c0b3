"""Expressions over the bars of a sequence.

An expression is a node of a graph; equal nodes are one object, so what several columns
share is computed once.  Nodes are of three kinds:

* pointwise: arithmetic and conditions on one row;
* window: lags, trailing frames of n rows and running sums over (sequence, time);
* scan: recursions whose state is carried from row to row (`scan` is true for these and
  for all that is built on them).

Missing is NULL (NaN in kernels).  A frame gives a value only if all its n values are
there.  Comparisons with a missing value are false (`ne` is true), and a condition that
is missing takes the else branch.  `/` gives NULL for a zero divisor; `ieee` keeps
infinities where a later sum, recursion or reciprocal needs them; they end as NULL.  A
column's name may have a mark behind it that it holds infinities.
"""

from __future__ import annotations

Number = "Expr | float | int"

POINTWISE = {"add", "sub", "mul", "div", "ieee", "neg", "abs", "sqrt", "sign", "lt", "le", "gt", "ge", "eq", "ne", "and", "or", "where", "max2", "min2", "maxskip", "minskip", "coalesce", "clip0", "number", "nullzero", "finite"}
WINDOW = {"lag", "avg", "sum", "max", "min", "std", "stdraw", "stdsample", "count", "cumsum", "masked", "rownum", "line", "weigh", "spread", "rank", "since_max", "since_min"}
SCAN = {"ema", "ewm", "wsma", "smooth", "psar", "psar_up", "supertrend", "supertrend_dir", "fisher", "utbot", "utbot_signal", "compound", "run"}


class Expr:
    __slots__ = ("op", "args", "p", "scan", "level", "inf", "key")
    _pool: dict = {}

    def __new__(cls, op: str, *args: Number, p: tuple = ()):
        args = tuple(a if isinstance(a, Expr) else const(a) for a in args)
        key = (op, tuple(id(a) for a in args), p)
        if key in cls._pool:
            return cls._pool[key]
        self = object.__new__(cls)
        self.op, self.args, self.p, self.key = op, args, p, f"x{len(cls._pool)}"
        self.scan = op in SCAN or any(a.scan for a in args)
        self.level = max((a.level for a in args), default=0) + (op in WINDOW or op in SCAN)
        self.inf = op == "ieee" or op == "column" and len(p) > 1 or op in POINTWISE - {"finite", "lt", "le", "gt", "ge", "eq", "ne", "and", "or", "number", "div"} | {"lag", "cumsum", "wsma", "smooth"} and any(a.inf for a in args)
        cls._pool[key] = self
        return self

    def __reduce__(self):
        return _rebuild, (_flat(self),)

    def __add__(self, x): return Expr("add", self, x)
    def __radd__(self, x): return Expr("add", x, self)
    def __sub__(self, x): return Expr("sub", self, x)
    def __rsub__(self, x): return Expr("sub", x, self)
    def __mul__(self, x): return Expr("mul", self, x)
    def __rmul__(self, x): return Expr("mul", x, self)
    def __truediv__(self, x): return Expr("div", self, x)
    def __rtruediv__(self, x): return Expr("div", x, self)
    def __neg__(self): return Expr("neg", self)
    def __abs__(self): return Expr("abs", self)
    def __lt__(self, x): return Expr("lt", self, x)
    def __le__(self, x): return Expr("le", self, x)
    def __gt__(self, x): return Expr("gt", self, x)
    def __ge__(self, x): return Expr("ge", self, x)
    def __and__(self, x): return Expr("and", self, x)
    def __or__(self, x): return Expr("or", self, x)
    def eq(self, x): return Expr("eq", self, x)
    def ne(self, x): return Expr("ne", self, x)


def _flat(e: Expr) -> list[tuple]:
    """The nodes below e, arguments first, each naming its arguments by place."""
    place: dict[Expr, int] = {}
    out, stack = [], [(e, False)]
    while stack:
        x, done = stack.pop()
        if x in place:
            continue
        if done:
            place[x] = len(out)
            out.append((x.op, tuple(place[a] for a in x.args), x.p))
        else:
            stack += [(x, True), *((a, False) for a in x.args)]
    return out


def _rebuild(nodes: list[tuple]) -> Expr:
    made: list[Expr] = []
    for op, args, p in nodes:
        made.append(Expr(op, *(made[i] for i in args), p=p))
    return made[-1]


def const(x: float) -> Expr:
    return Expr("const", p=(float(x),))


def column(name: str) -> Expr:
    return Expr("column", p=(name,))


O, H, L, C, V, OI = (column(c) for c in ("open", "high", "low", "close", "volume", "open_interest"))
NULL = Expr("null")


def ieee(a, b): return Expr("ieee", a, b)
def where(c, a, b): return Expr("where", c, a, b)
def sqrt(x): return Expr("sqrt", x)
def sign(x): return Expr("sign", x)
def max2(a, b): return Expr("max2", a, b)
def min2(a, b): return Expr("min2", a, b)
def maxskip(*a): return Expr("maxskip", *a)
def minskip(*a): return Expr("minskip", *a)
def coalesce(a, b): return Expr("coalesce", a, b)
def clip0(x): return Expr("clip0", x)
def number(c): return Expr("number", c)
def nullzero(x): return Expr("nullzero", x)
def finite(x): return Expr("finite", x)
def lag(x, n=1): return x if n == 0 else Expr("lag", x, p=(int(n),))
def avg(x, n): return Expr("avg", x, p=(n,))
def total(x, n): return Expr("sum", x, p=(n,))
def highest(x, n): return Expr("max", x, p=(n,))
def lowest(x, n): return Expr("min", x, p=(n,))
def std(x, n): return Expr("std", x, p=(n,))
def std_raw(x, n): return Expr("stdraw", x, p=(n,))
def std_sample(x, n): return Expr("stdsample", x, p=(n,))
def count_true(c, n): return Expr("count", c, p=(n,))
def running(x): return Expr("cumsum", x)
def mask_first(x): return Expr("masked", x)
def diff(x, n=1): return x - lag(x, n)
def change(x, n=1): return x / lag(x, n) - 1
def ema(x, n, least=None): return Expr("ema", x, p=(2.0 / (n + 1.0), n if least is None else least))
def ema_masked(x, n): return where(running(number(running(number(x.eq(x))) > 0)) >= n, ema(x, n, 0), NULL)
def rma(x, n): return Expr("ewm", x, p=(1.0 / n,))
def wsma(x, n, m=1): return Expr("wsma", x, p=(m / n,))
def smooth(x, n, m=1): return Expr("smooth", x, p=(n, m))


def line(x, n, first, step):
    """Sum of the last n rows times first, first + step, ..., oldest row first."""
    return Expr("line", x, p=(n, float(first), float(step)))


def dot(x, weights):
    """Weighted sum of the last rows, oldest weight first."""
    return Expr("weigh", x, p=(len(weights), *map(float, weights)))


def wma(x, n):
    return line(x, n, 1, 1) / (n * (n + 1) / 2)


def slope(x, n):
    """Least-squares slope over the last n rows."""
    return line(x, n, -(n - 1) / 2, 1) / (n * (n * n - 1) / 12)


def endpoint(x, n):
    """The least-squares line's value at the last row."""
    return avg(x, n) + slope(x, n) * ((n - 1) / 2)


def mean_deviation(x, n):
    return Expr("spread", x, avg(x, n), p=(n,)) / n


def rank_share(x, n):
    """Rank of the last of n values, ties averaged, as a share of n."""
    return Expr("rank", x, p=(n,)) / n


def bars_since(x, n, best):
    """Rows since the first of the best of the last n values; best: highest or lowest."""
    return Expr("since_max" if best is highest else "since_min", x, best(x, n), p=(n,))


def cross(a, b):
    """a has come from b or below it to above it."""
    a, b = (x if isinstance(x, Expr) else const(x) for x in (a, b))
    return (a > b) & (lag(a) <= lag(b))


def rising(x, n):
    """x is above what it was n rows before."""
    return x > lag(x, n)


def true_range(high, low, close):
    """Terms that need the row before are skipped on the first row."""
    return maxskip(high - low, abs(high - lag(close)), abs(low - lag(close)))


def zscore(x, n, tiny=1e-10):
    s = std(x, n)
    return (x - avg(x, n)) / where(s < tiny, 0.0, s)
