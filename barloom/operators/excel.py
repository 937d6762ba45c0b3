"""The 66 columns of the excel family; a zero divisor gives NULL at once."""

from __future__ import annotations

from ..functions.expr import C, H, L, O, V, avg, clip0, diff, ema, highest, lag, lowest, smooth, total, true_range, where, wma


def columns() -> dict:
    mean = lambda x, n: ema(x, n, 0)  # noqa: E731  seeded by the first value, no warm-up
    e20, e60 = mean(C, 20), mean(C, 60)
    off = C - avg(C, 40)
    plus, minus = total(where(off > 0, off, 0), 21), total(where(off < 0, -off, 0), 21)
    tii = 100 * (plus / (plus + minus))
    e9, e26 = mean(C, 9), mean(C, 26)
    p100 = diff(C, 100) / lag(C, 100)
    dema = lambda n: 2 * mean(C, n) - mean(mean(C, n), n)
    typical = (C + H + L) / 3
    e13 = mean(C, 13)
    up, low = highest(H, 20), lowest(L, 20)
    moved = diff(C)
    vary = abs(diff(C, 10)) / total(abs(moved), 10)
    tr = true_range(H, L, C)
    mid, a20, a14 = avg(C, 20), avg(tr, 20), avg(tr, 14)
    spread, base = mean(mean(H - L, 10), 10), mean(e20, 20)
    gain = clip0(moved)
    rsi = 100 * (smooth(gain, 40, 1) / smooth(abs(moved), 40, 1))
    triple = mean(mean(e20, 20), 20)
    weighted = (H + L + 2 * C) / 4
    above, below = H - lag(H), lag(L) - L
    dmax, dmin = avg(where(above > 0, above, 0), 20), avg(where(below > 0, below, 0), 20)
    rise, fall = total(where(C > O, C - O, 0), 14), total(where(O > C, O - C, 0), 14)
    ups, downs = total(clip0(moved), 20), total(clip0(-moved), 20)
    osc = C - avg(C, 40)
    clv = (2 * C - L - H) / (H - L)
    tema = lambda n: 3 * mean(C, n) - 3 * mean(mean(C, n), n) + mean(mean(mean(C, n), n), n)
    v12, v26, v20 = mean(V, 12), mean(V, 26), mean(V, 20)
    macdv = v20 - mean(V, 40)
    bias = lambda n: (V - avg(V, n)) / avg(V, n)
    out = {
        "ER_bull_power_20": H - e20, "ER_bear_power_20": L - e20, "TII_40_21": tii, "TII_signal_9": mean(tii, 9),
        "PO_9_26": 100 * ((e9 - e26) / e26), "MADisplaced_20_10": lag(avg(C, 20), 10),
        "POS_100": (p100 - lowest(p100, 100)) / (highest(p100, 100) - lowest(p100, 100)),
        "PAC_upper_20": smooth(H, 20, 1), "PAC_lower_20": smooth(L, 20, 1), "ZLMACD_20_100": dema(20) - dema(100),
        "TMA_20": avg(avg(C, 20), 20), "TYP": typical, "TYPMA1_10": mean(typical, 10), "TYPMA2_30": mean(typical, 30),
        "VMA_20": avg((H + L + O + C) / 4, 20), "WMA_20": wma(C, 20), "HMA_high_20": avg(H, 20),
        "SROC_13_21": diff(e13, 21) / lag(e13, 21), "EXPMA_12": mean(C, 12), "EXPMA_50": mean(C, 50),
        "DC_upper_20": up, "DC_lower_20": low, "DC_middle_20": (up + low) / 2,
        "VIDYA_10": vary * C + (1 - vary) * lag(C), "Qstick_20": avg(C - O, 20),
    }
    for k, name in ((1.618, "1_618"), (2.618, "2_618"), (4.236, "4_236")):
        out |= {f"FB_upper_{name}": mid + k * a20, f"FB_lower_{name}": mid - k * a20}
    out |= {
        "DEMA_60": 2 * e60 - mean(e60, 60), "APZ_upper_10_20": base + 2 * spread, "APZ_lower_10_20": base - 2 * spread,
        "KC_upper_14_20": e20 + 2 * a14, "KC_lower_14_20": e20 - 2 * a14, "BOP_20": avg((C - O) / (H - L), 20),
        "ENV_upper_25_5pct": avg(C, 25) * 1.05, "ENV_lower_25_5pct": avg(C, 25) * 0.95, "RSIH_40_120": rsi - mean(rsi, 120),
        "HLMA_high_20": avg(H, 20), "HLMA_low_20": avg(L, 20), "TRIX_20": diff(triple) / lag(triple),
        "WC_ema20": mean(weighted, 20), "WC_ema40": mean(weighted, 40), "Demarker_20": dmax / (dmax + dmin),
        "TSI_25_13": 100 * (mean(mean(moved, 25), 13) / mean(mean(abs(moved), 25), 13)), "IMI_14": rise / (rise + fall),
        "CMO_20": 100 * ((ups - downs) / (ups + downs)), "OSC_40": osc, "OSCMA_20": avg(osc, 20), "CLV": clv, "CLVMA_60": avg(clv, 60),
        "TEMA_20": tema(20), "TEMA_40": tema(40), "PVO_12_26": (v12 - v26) / v26,
        "BIASVOL_6": bias(6), "BIASVOL_12": bias(12), "BIASVOL_24": bias(24), "MACDVOL_20_40": macdv, "MACDVOL_signal_10": avg(macdv, 10),
        "ROCVOL_80": diff(V, 80) / lag(V, 80), "VWAP_20": total(V * typical, 20) / total(V, 20), "FI_13": mean(moved * V, 13),
        "MAAMT_40": avg(C * V, 40), "SROCVOL_20_10": diff(v20, 10) / lag(v20, 10),
    }
    return {f"excel_{k}": v for k, v in out.items()}
