"""The 59 columns of the indicator family; five of them build on the other families' columns."""

from __future__ import annotations

from ..functions.expr import C, H, L, OI, V, avg, change, coalesce, diff, ema, highest, lag, lowest, mask_first, number, rank_share, std_sample, true_range, zscore


def columns(base: dict) -> dict:
    """base: the wh6 columns."""
    macd, rsi, atr = base["wh6_MACD_MACD"], base["wh6_RSI_RSI2"], base["wh6_ATR_ATR"]
    place, width = base["wh6_Z_SCORE_Z_SCORE"], base["wh6_u_8b96f436_BBW"]
    ma = {n: avg(C, n) for n in (5, 10, 20, 40, 60, 120)}
    ret = change(C)
    vol = {n: std_sample(ret, n) for n in (5, 10, 20)}
    high, low = lag(highest(H, 20)), lag(lowest(L, 20))
    in_range = lambda n: (C - lowest(L, n)) / (highest(H, n) - lowest(L, n))
    tr = true_range(H, L, C)
    slow, fast = ema(C, 26), ema(C, 12)
    gap = lambda a, b: (ma[a] - ma[b]) / ma[b]
    up, down, more, held = C > lag(C), C < lag(C), V > lag(V), OI > lag(OI)
    out = {f"ret_{n}": change(C, n) for n in (1, 3, 5, 10, 20)}
    out |= {f"momentum_{n}": diff(C, n) for n in (5, 10, 20)}
    for n in ma:
        out |= {f"ma{n}_slope": change(ma[n]), f"close_to_ma{n}": (C - ma[n]) / ma[n]}
    out |= {f"ma{a}_ma{b}_gap": gap(a, b) for a, b in ((5, 10), (5, 20), (10, 20), (20, 40), (20, 60), (40, 120))}
    out |= {
        "macd_hist_diff": diff(macd / 2), "ppo": (fast - slow) / slow, "rsi_diff": mask_first(diff(rsi)), "rsi_zscore_20": mask_first(zscore(rsi, 20)),
        "hl_pct": (H - L) / C, "tr_ratio": tr / C, "atr_norm": coalesce(atr, avg(tr, 14)) / C,
        "volatility_5": vol[5], "volatility_10": vol[10], "volatility_20": vol[20], "vol_ratio_5_20": vol[5] / vol[20],
        "break_high_20": number(C > high), "break_low_20": number(C < low), "dist_prev_high_20": (C - high) / high, "dist_prev_low_20": (C - low) / low,
        "pos_in_range_20": in_range(20), "pos_in_range_60": in_range(60), "close_pos": (C - L) / (H - L),
        "boll_pct_b": 0.5 + place / 4, "boll_width": width, "zscore_close_20": place, "zscore_volume_20": zscore(V, 20),
        "close_rank_60": rank_share(C, 60), "volume_rank_60": rank_share(V, 60), "vol_ratio_5": V / avg(V, 5), "vol_ratio_20": V / avg(V, 20),
        "volume_diff": diff(V), "oi_diff": diff(OI), "oi_ratio_5": OI / avg(OI, 5),
        "price_up_vol_up": number(up & more), "price_down_vol_up": number(down & more), "price_up_oi_up": number(up & held), "price_down_oi_up": number(down & held),
    }
    return {f"indicator_py_{k}": v for k, v in out.items()}
