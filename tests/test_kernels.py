"""Recursions against literal loops and pandas; frames against pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.functions import expr as X
from barloom.functions import kernels as K

NAN = float("nan")
cells = st.lists(st.one_of(st.floats(-1e3, 1e3).map(lambda x: round(x, 3)), st.just(NAN)), min_size=1, max_size=60)


def one(e, **columns):
    base = dict.fromkeys(("open", "high", "low", "close", "volume", "open_interest"), np.zeros(len(next(iter(columns.values())))))
    return K.evaluate([e], base | {k: np.array(v, float) for k, v in columns.items()})[0]


@settings(deadline=None, max_examples=60)
@given(cells, st.integers(1, 12))
def test_ewm_is_that_of_pandas(values, n):
    x = np.array(values)
    for alpha, least in ((2 / (n + 1), n), (1 / n, 0)):
        want = pd.Series(x).ewm(alpha=alpha, adjust=False, min_periods=least).mean()
        np.testing.assert_allclose(K.ewm(x, alpha, least), want, rtol=1e-9, atol=1e-9)


@settings(deadline=None, max_examples=60)
@given(cells, st.integers(1, 9))
def test_frames_are_those_of_pandas(values, n):
    s = pd.Series(values)
    roll = s.rolling(n, min_periods=n)
    for e, want in ((X.avg(X.C, n), roll.mean()), (X.total(X.C, n), roll.sum()), (X.highest(X.C, n), roll.max()), (X.lowest(X.C, n), roll.min()), (X.lag(X.C, n), s.shift(n)), (X.running(X.C), s.cumsum())):
        np.testing.assert_allclose(one(e, close=values), want, rtol=1e-7, atol=1e-6)


def test_recursive_average_repeats_over_gaps():
    np.testing.assert_allclose(K.wsma(np.array([NAN, 4, NAN, 8]), 0.25), [NAN, 4, 4, 5])
    np.testing.assert_allclose(K.smooth(np.array([NAN, 4, NAN, 8]), 4, 1), [NAN, 4, 4, 5])


def literal_ema(values, n, least):
    """One value at a time: the first one seeds, gaps keep the state, the first least - 1 are hidden."""
    out, state, seen, a = [], None, 0, 2 / (n + 1)
    for v in values:
        if not math.isnan(v):
            state = v if state is None else (1 - a) * state + a * v
            seen += 1
        out.append(state if seen >= least and state is not None else NAN)
    return out


def test_ema_begins_where_its_observations_are_enough():
    r = np.random.default_rng(41)
    for n, lead in ((3, 0), (7, 0), (7, 2), (11, 5)):
        close = [NAN] * lead + r.normal(50, 4, 19).tolist()
        got = one(X.ema(X.C, n), close=close)
        np.testing.assert_allclose(got, literal_ema(close, n, n), rtol=1e-12)
        assert np.flatnonzero(~np.isnan(got))[0] == lead + n - 1


def test_rank_averages_ties():
    close = [*range(1, 60), 59]
    assert one(X.rank_share(X.C, 60), close=close)[-1] == pytest.approx(59.5 / 60)


def test_bars_since_takes_the_oldest_of_equals():
    high = [5.0, 9, 9, *[1.0] * 22]
    assert one(X.bars_since(X.H, 25, X.highest), high=high)[-1] == 23


def test_weighted_average_and_line():
    x = np.arange(10, dtype=float) ** 1.5
    i = np.arange(10)
    assert one(X.wma(X.C, 10), close=x)[-1] == pytest.approx((x * (i + 1)).sum() / 55)
    k, b = np.polyfit(i, x, 1)
    assert one(X.slope(X.C, 10), close=x)[-1] == pytest.approx(k)
    assert one(X.endpoint(X.C, 10), close=x)[-1] == pytest.approx(9 * k + b)


def test_money_flow_against_a_loop():
    from barloom.operators.registry import select

    mfi = select(["tv_mfi_14"])["tv_mfi_14"]
    r = np.random.default_rng(43)
    walk = 70 + r.normal(size=33).cumsum()
    for c in (walk, np.sort(walk), np.sort(walk)[::-1], np.full(33, 70.0)):
        high, low, volume = c + r.random(33), c - r.random(33), r.integers(1, 90, 33).astype(float)
        if (c == c[0]).all():
            high, low = c + 0.5, c - 0.5
        typical, want = (high + low + c) / 3, []
        for i in range(33):
            plus = minus = 0.0
            for j in range(max(1, i - 13), i + 1):
                plus += typical[j] * volume[j] * (typical[j] > typical[j - 1])
                minus += typical[j] * volume[j] * (typical[j] < typical[j - 1])
            want.append(NAN if i < 13 or plus == minus == 0 else 100 - 100 / (1 + plus / minus) if minus else 100)
        np.testing.assert_allclose(one(mfi, high=high, low=low, close=c, volume=volume), want, rtol=1e-9)


def test_fisher_against_a_loop_with_flat_ranges():
    from barloom.operators.registry import select

    r = np.random.default_rng(47)
    c = 30 + r.normal(size=75).cumsum()
    high, low = c + r.random(75), c - r.random(75)
    for b, e in ((11, 27), (52, 63)):
        c[b:e] = high[b:e] = low[b:e] = 31.5
    value = state = 0.0
    want = []
    for i in range(75):
        if i < 9 or (top := high[i - 9 : i + 1].max()) == (least := low[i - 9 : i + 1].min()):
            want.append(NAN)
            continue
        value = min(0.999, max(-0.999, 0.66 * ((c[i] - least) / (top - least) - 0.5) + 0.67 * value))
        state = 0.5 * math.log((1 + value) / (1 - value)) + 0.5 * state
        want.append(state)
    e = select(["tv_fisher_10", "tv_fisher_trigger"])
    line, trigger = K.evaluate(e.values(), {"high": high, "low": low, "close": c, "open": c, "volume": c, "open_interest": c})
    assert np.isnan(want[20:27]).all() and not np.isnan(want[27])
    np.testing.assert_allclose(line, want, rtol=1e-9)
    np.testing.assert_allclose(trigger, [NAN, *want[:-1]], rtol=1e-9)


def test_runs_and_compounds():
    np.testing.assert_array_equal(K.run(np.array([False, True, True, False, True])), [0, 1, 2, 0, 1])
    np.testing.assert_allclose(K.compound(np.array([NAN, 0.1, 0.5]), np.array([False, True, False]), 1000.0), [1000, 1100, 1100])


@pytest.mark.parametrize("up", [True, False])
def test_parabolic_stop_does_not_look_ahead(up):
    r = np.random.default_rng(3)
    c = 100 + r.normal(size=80).cumsum()
    h, l = c + r.random(80), c - r.random(80)
    whole = K.psar(h, l, c, 0.02, 0.2, up=up)
    for n in (1, 2, 10, 33):
        np.testing.assert_array_equal(K.psar(h[:n], l[:n], c[:n], 0.02, 0.2, up=up), whole[:n])
    assert len(K.psar(h[:0], l[:0], c[:0], 0.02, 0.2, up=up)) == 0


@pytest.mark.parametrize("cuts", [[1, 2, 3, 50, 171, 180], [130], range(1, 240)])
def test_a_sequence_in_parts_has_the_values_of_the_whole(cuts):
    """All columns: frames, running sums and recursions go on where the part before ended."""
    from barloom.operators.registry import every
    from tests.test_features import made

    f = made(240, 11, flat=range(165, 189), quiet=[0, 83, 84, 219])
    bars = {c: f[c].to_numpy(float) for c in ("open", "high", "low", "close", "volume", "open_interest")}
    whole, held, got = K.evaluate(every().values(), bars), [], []
    for a, b in zip([0, *cuts], [*cuts, 240], strict=True):
        got.append(K.evaluate(every().values(), {k: v[a:b] for k, v in bars.items()}, held))
    got.append(K.evaluate(every().values(), {k: v[:0] for k, v in bars.items()}, held))
    for i, name in enumerate(every()):
        np.testing.assert_allclose(np.concatenate([p[i] for p in got]), whole[i], rtol=1e-9, atol=1e-9, err_msg=name)


@settings(deadline=None, max_examples=60)
@given(cells, st.integers(1, 9))
def test_masked_mean_hides_the_rows_behind_the_first_value(values, n):
    s = pd.Series(values)
    want = s.ewm(span=n, adjust=False).mean()
    first = s.first_valid_index()
    if first is not None:
        want.iloc[first : first + n - 1] = NAN
    np.testing.assert_allclose(one(X.ema_masked(X.C, n), close=values), want, rtol=1e-9, atol=1e-9)
