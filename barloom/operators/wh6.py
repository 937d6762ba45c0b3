"""The 198 columns of the wh6 family, grouped as their formulas are.

`/` stands where a quotient by zero ends as missing in either arithmetic: it is the result,
it meets a frame (which takes infinities for missing), or its numerator is zero too.  Where
such a quotient is compared, summed without a frame or carried on, it is `ieee`.
"""

from __future__ import annotations

from ..functions.expr import C, H, L, NULL, O, OI, V, Expr, avg, const, count_true, diff, dot, ema, endpoint, highest, ieee, lag, lowest, max2, mean_deviation, min2, running, std, total, where, wsma


def _range(first: Expr, second: Expr, third: Expr) -> Expr:
    """The true range; missing in a row that has no row before."""
    return max2(max2(first, abs(second)), abs(third))


def _rsi(x: Expr, n: int) -> Expr:
    return wsma(max2(diff(x), 0), n) / wsma(abs(diff(x)), n) * 100


def _balance(plus: Expr, minus: Expr) -> Expr:
    """(plus - minus) over the larger of the two, 0 if they are equal."""
    return where(plus > minus, (plus - minus) / plus, where(plus.eq(minus), 0, (plus - minus) / minus))


def _place(n: int) -> Expr:
    return (C - lowest(L, n)) / (highest(H, n) - lowest(L, n)) * 100


def _flow(n: int) -> Expr:
    typical = (H + L + C) / 3
    up, down = total(where(typical > lag(typical), typical * V, 0), n), total(where(typical < lag(typical), typical * V, 0), n)
    return 100 - ieee(const(100), 1 + ieee(up, down))


def _swings() -> tuple[Expr, Expr]:
    moved = max2(abs(diff(H)), abs(diff(L)))
    now, before = H + L, lag(H) + lag(L)
    return where(now <= before, 0, moved), where(now >= before, 0, moved)


def oscillators() -> dict:
    p = lag(C)
    stm = total(where(O <= lag(O), 0, max2(H - O, O - lag(O))), 23)
    sbm = total(where(O >= lag(O), 0, max2(O - L, lag(O) - O)), 23)
    adtm = _balance(stm, sbm)
    aa, bb, cc, dd = abs(H - p), abs(L - p), abs(H - lag(L)), abs(p - lag(O))
    r = where((aa > bb) & (aa > cc), aa + bb / 2 + dd / 4, where((bb > cc) & (bb > aa), bb + aa / 2 + dd / 4, cc + dd / 4))
    swing = ieee(16 * (C - p + (C - O) / 2 + p - lag(O)), r) * max2(aa, bb)
    tr = _range(H - L, p - H, p - L)
    typical = (C + H + L) / 3
    mid = (H + L + C) / 3
    cr = total(max2(0, H - lag(mid)), 26) / total(max2(0, lag(mid) - L), 26) * 100
    out = {
        "ADTM_ADTM": adtm, "ADTM_ADTMMA": avg(adtm, 8),
        "ARBR_AR": total(H - O, 26) / total(O - L, 26) * 100, "ARBR_BR": total(max2(0, H - p), 26) / total(max2(0, p - L), 26) * 100,
        "ASI_ASI": running(swing), "ATR_TR": tr, "ATR_ATR": avg(tr, 14), "B3612_B36": avg(C, 3) - avg(C, 6), "B3612_B612": avg(C, 6) - avg(C, 12),
    }
    out |= {f"BIAS_BIAS{i}": (C - avg(C, n)) / avg(C, n) * 100 for i, n in enumerate((6, 12, 20), 1)}
    out |= {"CCI_CCI": (typical - avg(typical, 100)) / mean_deviation(typical, 100) / 0.015, "CR_CR": cr}
    out |= {f"CR_CRMA{i}": lag(avg(cr, n), int(n / 2.5 + 1)) for i, n in enumerate((5, 10, 20, 40), 1)}
    bias = ieee(C - avg(C, 5), avg(C, 5))
    dbcd = wsma(bias - lag(bias, 16), 76)
    plus, minus = _swings()
    sp, sm = total(plus, 13), total(minus, 13)
    ddi = sp / (sp + sm) - sm / (sm + sp)
    addi = wsma(ddi, 30, 10)
    ddd = avg(C, 10) - avg(C, 50)
    fell, rose = lag(L) - L, H - lag(H)
    spread = total(_range(H - L, H - p, L - p), 14)
    pdi = total(where((rose > 0) & (rose > fell), rose, 0), 14) * 100 / spread
    mdi = total(where((fell > 0) & (fell > rose), fell, 0), 14) * 100 / spread
    adx = avg(abs(mdi - pdi) / (mdi + pdi) * 100, 6)
    out |= {
        "DBCD_DBCD": dbcd, "DBCD_MM": avg(dbcd, 5), "DDI_DDI": ddi, "DDI_ADDI": addi, "DDI_AD": avg(addi, 5), "DMA_DDD": ddd, "DMA_AMA": avg(ddd, 10),
        "DMI_PDI": pdi, "DMI_MDI": mdi, "DMI_ADX": adx, "DMI_ADXR": (adx + lag(adx, 6)) / 2, "DPO_DPO": C - lag(avg(C, 20), 11),
    }
    k6 = wsma(_place(17), 6)
    k3 = wsma(_place(9), 3)
    d3 = wsma(k3, 3)
    long = running(diff(C) * ieee(total(V, 2), (highest(H, 2) - lowest(L, 2)) * 100))
    lon = wsma(long, 10) - wsma(long, 20)
    dif = ema(C, 12) - ema(C, 26)
    dea = ema(dif, 9)
    e9 = ema(H - L, 9)
    ami = wsma(diff(C), 8)
    micd = avg(lag(ami), 3) - avg(lag(ami), 8)
    mtm = diff(C, 6)
    psy = count_true(C > p, 12) / 12 * 100
    out |= {
        "KD_K": k6, "KD_D": wsma(k6, 6), "KDJ_K": k3, "KDJ_D": d3, "KDJ_J": 3 * k3 - 2 * d3, "LON_LON": lon, "LON_LONGMA": avg(lon, 10), "LON_LONGT": lon,
        "MACD_DIFF": dif, "MACD_DEA": dea, "MACD_MACD": 2 * (dif - dea), "MASS_MASS": total(e9 / ema(e9, 9), 25), "MFI_MFI": _flow(14),
        "MI_A": diff(C, 12), "MI_MI": wsma(diff(C, 12), 12), "MICD_DIF": micd, "MICD_MICD": wsma(micd, 10), "MTM_MTM": mtm, "MTM_MTMMA": avg(mtm, 6),
        "PRICEOSC_PRICEOSC": (avg(C, 12) - avg(C, 26)) / avg(C, 12) * 100, "PSY_PSY": psy, "PSY_PSYMA": avg(psy, 6),
    }
    qhl = C - p - ieee((V - lag(V)) * (lag(H) - lag(L)), lag(V))
    up = lambda n: total(where(qhl > 0, qhl, 0), n)
    down = lambda n: abs(total(where(qhl < 0, qhl, 0), n))
    ones = lambda c: total(where(c, 1, 0), 5)
    rc = lambda n: wsma(lag(ieee(C, lag(C, n))), n)
    rccd = avg(lag(rc(59)), 21) - avg(lag(rc(59)), 28)
    roc = diff(C, 24) / lag(C, 24) * 100
    short = (C - avg(C, 24)) / avg(C, 24) * 100 * (1 + avg(diff(V) / lag(V), 5))
    fast = wsma(k3, 3)
    azm, afm = avg(plus, 10), avg(minus, 10)
    srdm = _balance(azm, afm)
    out |= {
        "QHLSR_QHL5": where(ones(qhl > 0).eq(5), 1, where(ones(qhl < 0).eq(5), 0, up(5) / (up(5) + down(5)))), "QHLSR_QHL10": up(10) / (up(10) + down(10)),
        "RC_ARC": rc(50), "RCCD_DIF": rccd, "RCCD_RCCD": wsma(rccd, 59), "ROC_ROC": roc, "ROC_ROCMA": avg(roc, 20), "RSI_RSI1": _rsi(C, 8), "RSI_RSI2": _rsi(C, 14),
        "SHORT_SHORT": short, "SHORT_SHORTMA": avg(short, 5), "SHORT_SHORTT": short, "SLOWKD_K": fast, "SLOWKD_D": wsma(fast, 3),
        "SRDM_SRDM": srdm, "SRDM_ASRDM": wsma(srdm, 30),
        "SRMI_SRMI": where(C < lag(C, 9), diff(C, 9) / lag(C, 9), where(C.eq(lag(C, 9)), 0, diff(C, 9) / C)),
    }
    r7 = _rsi(C, 7)
    top, low = highest(r7, 7), lowest(r7, 7)
    share = count_true(C >= p, 125) / count_true(C < p, 125)
    third = (C + L + H) / 3
    jcs = ema(running(ieee((third - lag(L) - (H - third)) * V / 100000, H - L)), 1)
    r12, r16, r18 = _rsi(C, 12), _rsi(C, 16), _rsi(C, 18)
    mms = avg(3 * r12 - 2 * r16, 3)
    out |= {
        "STOCHASTIC_RSI_RSI_BASE": r7, "STOCHASTIC_RSI_STOCH_RSI_RAW": where(top.eq(low), 50, (r7 - low) / (top - low) * 100),
        "WR_WR": -100 * (highest(H, 14) - C) / (highest(H, 14) - lowest(L, 14)), "ZDZB_B": avg(share, 5), "ZDZB_D": avg(share, 20),
        "ZLJC_JCS": jcs, "ZLJC_JCM": avg(jcs, 12), "ZLJC_JCL": avg(jcs, 26), "ZLMM_MMS": mms, "ZLMM_MMM": ema(mms, 8), "ZLMM_MML": avg(3 * r18 - 2 * r12, 5),
    }
    return out


def volumes() -> dict:
    p = lag(C)
    obv = running(where(C > p, V, where(C < p, -V, 0)))
    vosc = (avg(V, 12) - avg(V, 26)) / avg(V, 12) * 100
    price, volume = avg(C, 25), avg(V, 25)
    return {
        "AD_AD": running(ieee(C - L - (H - C), H - L) * V), "CCL_CCL": OI, "CJL_CJL": V, "MV_MV": V, "MV_MV_2": wsma(V, 10), "MV_MV_3": wsma(V, 20),
        "OBV_OBV": obv, "OBV_OBVMA": avg(obv, 20), "PVT_PVT": running(ieee(C - p, p) * V), "VOSC_VOSC": vosc, "VOSC_OBVMA": avg(vosc, 20),
        "VR_VR": total(where(C > p, V, 0), 25) / total(where(C <= p, V, 0), 25) * 100, "VROC_VROC": diff(V, 12) / lag(V, 12) * 100, "VRSI_VRSI": _rsi(V, 6),
        "WAD_WAD": running(where(C > p, C - min2(p, L), where(C < p, C - max2(p, H), 0))), "WVAD_WVAD": (C - O) / (H - L) * V,
        "u_78c25b4e_u_273a581d": price, "u_78c25b4e_u_2da16149": volume,
        "u_78c25b4e_DT1": where((price > lag(price)) & (volume > lag(volume)), price, NULL), "u_78c25b4e_KT1": where((price < lag(price)) & (volume < lag(volume)), price, NULL),
    }


def prices() -> dict:
    p = lag(C)
    e60 = ema(C, 60)
    bbi = (avg(C, 3) + avg(C, 6) + avg(C, 12) + avg(C, 24)) / 4
    spread = 3 * std(bbi, 10)
    mid, dev = avg(C, 26), std(C, 26)
    cdp, width = (H + L + C) / 3, lag(H) - lag(L)
    a = (3 * C + L + O + H) / 6
    # The row 19 back has no weight.
    dkx = dot(a, [1, 0, *range(2, 21)]) / 210
    typical, top, low = (H + L + C) / 3, highest(H, 12), lowest(L, 12)
    tr = _range(H - L, p - H, p - L)
    out = {
        "BAR_BAR": O, "CLOSE_CLOSE": C, "DEMA_DEMA": 2 * e60 - ema(e60, 60), "EMA_MA1": ema(C, 20), "EMA2_MA1": ema(C, 10), "HIGH_HIGH": H, "LOW_LOW": L,
        "MYFORCAST_MYFORCAST": endpoint(p, 10), "OPEN_OPEN": O, "SMA_SMA": wsma(C, 6, 2), "VOLATILITY_u_c40446c0": std(C / p - 1, 60) * 100,
        "u_d6d18ecd_u_d6d18ecd": C, "u_d6d18ecd_MA1": avg(C, 60), "BBI_BBI": bbi, "BBIBOLL_BBIBOLL": bbi, "BBIBOLL_UPR": bbi + spread, "BBIBOLL_DWN": bbi - spread,
        "BOLL_MID": mid, "BOLL_TOP": mid + 1.5 * dev, "BOLL_BOTTOM": mid - 1.5 * dev,
        "CDP_CDP": cdp, "CDP_AH": cdp + width, "CDP_AL": cdp - width, "CDP_NH": 2 * cdp - L, "CDP_NL": 2 * cdp - H, "DKX_B": dkx, "DKX_D": avg(dkx, 10),
        "ENV_UPPER": avg(C, 14) * (1 + 6 / 100), "ENV_LOWER": avg(C, 14) * (1 - 6 / 100), "HCL_MAH": avg(H, 10), "HCL_MAL": avg(L, 10), "HCL_MAC": avg(C, 10), "MA_MA1": avg(C, 10),
        "MIKE_WR": typical + (typical - low), "MIKE_MR": typical + (top - low), "MIKE_SR": 2 * top - low,
        "MIKE_WS": typical - (top - typical), "MIKE_MS": typical - (top - low), "MIKE_SS": 2 * low - top,
    }
    out |= {f"PUBU_PB{i}": (ema(C, n) + avg(C, 2 * n) + avg(C, 4 * n)) / 3 for i, n in enumerate((4, 6, 9, 13, 18, 24), 1)}
    sar = Expr("psar_up", H, L, C, p=(0.02, 0.2))
    out |= {
        "SAR_SARLINE": sar, "SAR1_SARLINE": sar, "SP_SP": C, "WTD_WTD": avg(C, 30), "u_6ae5cc5a_HH": highest(H, 20), "u_6ae5cc5a_LL": lowest(L, 20),
        "u_72bedb5a_MA15": avg(C, 15), "u_72bedb5a_MA30": avg(C, 30), "u_68173cb3_H20": highest(H, 20), "u_68173cb3_L20": lowest(L, 20),
        "u_5c41ea6d_MA5": avg(C, 5), "u_5c41ea6d_MA10": avg(C, 10), "u_5c41ea6d_MA30": avg(C, 30), "u_21e0022b_MA1": avg(C, 30),
        "u_9a0c2be9_MA5": avg(C, 5), "u_9a0c2be9_MA10": avg(C, 10), "u_9a0c2be9_MA30": avg(C, 30), "u_6f963dfa_MA5": avg(C, 5), "u_6f963dfa_MA10": avg(C, 10),
    }
    band, reach = "FIBONACCI_BANDS_FIBONACCI_BANDS", avg(tr, 20)
    out |= {band: avg(C, 20)} | {f"{band}_{i}": avg(C, 20) + k * reach for i, k in enumerate((1, 2, 3, -1, -2, -3), 2)}
    return out


def composites() -> dict:
    p = lag(C)
    roc = diff(C, 24) / lag(C, 24) * 100

    def place(n: int) -> Expr:
        r = _rsi(C, n)
        top, low = highest(r, n), lowest(r, n)
        return where(top.ne(low), (r - low) / (top - low) * 100, 0)

    gain, loss = ema(where(C > p, C - p, 0), 18), ema(where(C < p, p - C, 0), 18)
    wilder = 100 - ieee(const(100), 1 + ieee(gain, loss))
    bias = (C - avg(C, 12)) / avg(C, 12) * 100
    typical = (H + L + C) / 3
    cci = (typical - avg(typical, 14)) / (0.015 * mean_deviation(typical, 14)) / 100
    bounded = lambda x, k: x / (abs(x) + k)
    multi = (0 * ((_rsi(C, 7) - 50) / 50) + 0 * bounded(bias, 2) + 1 * bounded(roc, 2) + 0 * bounded(cci, 1) + 1) * 50
    mb, sd = avg(C, 20), std(C, 20)
    pressure, span = C - min2(L, p), max2(H, p) - min2(L, p)
    uo = lambda n: total(pressure, n) / total(span, n)
    reach, e20 = avg(H - L, 10), ema(C, 20)
    tr = _range(H - L, p - H, p - L)
    low, top = lowest(L, 20), highest(H, 20)
    name = "u_a8b37c90_u_a8b37c90"
    return {
        "ROC_ROC_2": roc, "ROC_ROCMA_2": avg(roc, 24), "ROC_ROC_B": roc / (abs(roc) + 8), "RSIS_RSIS1": place(120), "RSIS_RSIS2": place(240),
        "RSI_WILDER_RSI1": wilder, "RSI_WILDER_RSI2": ema(wilder, 9), "VWMA_VWMA3": total(C * V, 50) / total(V, 50), "Z_SCORE_Z_SCORE": (C - mb) / sd,
        "u_a8b37c90_MULTI": max2(min2(multi, 100), 0), name: const(50), f"{name}_2": const(79), f"{name}_3": const(21),
        "u_8b96f436_BBW": where(mb.eq(0), 0, (mb + 2 * sd - (mb - 2 * sd)) / mb), "u_dc9bfffe_UO": 100 * (4 * uo(7) + 2 * uo(14) + uo(28)) / 7,
        "u_495a23e5_MID": mb, "u_495a23e5_UPPER": mb + 2 * reach, "u_495a23e5_LOWER": mb - 2 * reach,
        "u_dcb52af4_MID": e20, "u_dcb52af4_TR": tr, "u_dcb52af4_AAA": avg(tr, 10), "u_dcb52af4_UPPER": e20 + 1.5 * avg(tr, 10), "u_dcb52af4_LOWER": e20 - 1.5 * avg(tr, 10),
        "MFI_MFI_2": _flow(14), "u_a4f8ae15_UPPER": top, "u_a4f8ae15_LOWER": low, "u_a4f8ae15_MIDDLE": (top + low) / 2,
    }


def columns() -> dict:
    return {f"wh6_{k}": v for part in (oscillators(), volumes(), prices(), composites()) for k, v in part.items()}
