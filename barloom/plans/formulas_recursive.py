"""SQL of recursive columns as their formulas are told, for a second engine.

As in `formulas`, nothing here knows the expression graph.  Three recursions, one on the other,
walk each sequence row by row; a mean that is shown only after `least` values is told by the
number of the row from which it is shown.  Bars have no gaps in their prices; where an input lacks
a value inside a sequence, its mean stands still.
"""

from __future__ import annotations

from . import formulas as f
from .formulas import _by, _hhv, _llv, _ma, _ref, _sum

_P = f._P
_UP, _DOWN, _MOVE = "(CASE WHEN c1 IS NOT NULL THEN greatest(close - c1, 0e0) END)", "(CASE WHEN c1 IS NOT NULL THEN greatest(c1 - close, 0e0) END)", "(close - c1)"


def _running(x: str) -> str:
    return f"sum({x}) OVER ({_P} ROWS UNBOUNDED PRECEDING)"


def _place(n: int) -> str:
    return _by(f"close - {_llv('low', n)}", f"{_hhv('high', n)} - {_llv('low', n)}") + " * 100"


# What the first recursion walks over: columns over `e`, some in two steps.
STEP = {
    "z_bias": _by(f"close - {_ma('close', 5)}", _ma("close", 5)), "z_ddi": f"{_by('sz', 'sz + sf')} - {_by('sf', 'sz + sf')}", "z_tii": f.EXCEL["TII_40_21"], "z_az": _ma("dmz", 10), "z_af": _ma("dmf", 10), "z_weighted": "(high + low + 2 * close) / 4",
    "z_obv": _running("coalesce(sign(close - c1), 0e0) * volume"), "z_adl": _running(f"coalesce(c1 * 0 + {_by('close - low - (high - close)', 'high - low')}, 0e0) * volume"), "z_v2": _sum("volume", 2), "z_w2": f"({_hhv('high', 2)} - {_llv('low', 2)}) * 100",
    "z_dead": _running("CASE WHEN high = low AND typical - l1 - (high - typical) <> 0 THEN 1 ELSE 0 END"), "z_r59": f"close / lag(close, 59) OVER ({_P})", "z_r50": f"close / lag(close, 50) OVER ({_P})", "z_tr_up": "CASE WHEN close > c1 THEN close - c1 ELSE 0e0 END", "z_tr_down": "CASE WHEN close < c1 THEN c1 - close ELSE 0e0 END",
    "z_p17": _place(17), "z_p9": _place(9), "z_top10": _hhv("high", 10), "z_low10": _llv("low", 10), "z_k12": f"close - lag(close, 12) OVER ({_P})",
}
# A quotient by a range of zero is infinite, and the sum after it: its mean stays at what was before.
STEP2 = {"z_jcs": _running("CASE WHEN z_dead = 0 THEN (typical - l1 - (high - typical)) * volume / 100000 / nullif(high - low, 0) END"), "z_long": _running(_by(f"{_MOVE} * z_v2", "z_w2")), "z_dbcd": f"z_bias - lag(z_bias, 16) OVER ({_P})", "z_srdm": f"CASE WHEN z_az > z_af THEN {_by('z_az - z_af', 'z_az')} WHEN z_az = z_af THEN 0e0 ELSE {_by('z_az - z_af', 'z_af')} END", "z_q59": _ref("z_r59"), "z_q50": _ref("z_r50")}


def _mean(weight: str) -> tuple[str, str]:
    """First and next value of a mean of {x}; {y} is the value before."""
    return "{x}", f"CASE WHEN {{x}} IS NULL THEN {{y}} WHEN {{y}} IS NULL THEN {{x}} ELSE (1 - {weight}) * {{y}} + {weight} * {{x}} END"


def _ema(n: int) -> tuple[str, str]:
    return _mean(f"(2e0 / {n + 1})")


def _sma(n: int, m: int = 1) -> tuple[str, str]:
    return _mean(f"({m}e0 / {n})")


# name: input, first and next value.
FIRST = {f"c{n}_e": ("close", *_ema(n)) for n in (4, 6, 8, 9, 10, 12, 13, 18, 20, 21, 23, 24, 26, 34, 40, 50, 55, 60, 100)}
FIRST |= {f"g{n}_w": (_UP, *_sma(n)) for n in (7, 8, 12, 14, 16, 18, 21, 40, 120, 240)} | {f"a{n}_w": (f"abs({_MOVE})", *_sma(n)) for n in (7, 8, 12, 14, 16, 18, 40, 120, 240)} | {f"l{n}_w": (_DOWN, *_sma(n)) for n in (7, 14, 21)}
FIRST |= {f"v{n}_e": ("volume", *_ema(n)) for n in (12, 20, 26, 40)} | {f"v{n}_w": ("volume", *_sma(n)) for n in (10, 20)} | {f"t{n}_w": ("tr0", *_sma(n)) for n in (10, 14, 21)}
FIRST |= {
    "t10_e": ("typical", *_ema(10)), "t30_e": ("typical", *_ema(30)), "r9_e": ("high - low", *_ema(9)), "r10_e": ("high - low", *_ema(10)), "m25_e": (_MOVE, *_ema(25)), "n25_e": (f"abs({_MOVE})", *_ema(25)), "f13_e": (f"{_MOVE} * volume", *_ema(13)), "tii_e": ("z_tii", *_ema(9)),
    "x20_e": ("z_weighted", *_ema(20)), "x40_e": ("z_weighted", *_ema(40)), "obv_e": ("z_obv", *_ema(20)), "adl3_e": ("z_adl", *_ema(3)), "adl10_e": ("z_adl", *_ema(10)), "up18_e": ("z_tr_up", *_ema(18)), "down18_e": ("z_tr_down", *_ema(18)),
    "vg_w": ("CASE WHEN v1 IS NOT NULL THEN greatest(volume - v1, 0e0) END", *_sma(6)), "va_w": ("abs(volume - v1)", *_sma(6)), "dbcd_w": ("z_dbcd", *_sma(76)), "addi_w": ("z_ddi", *_sma(30, 10)), "k17_w": ("z_p17", *_sma(6)), "k9_w": ("z_p9", *_sma(3)), "lon10_w": ("z_long", *_sma(10)), "lon20_w": ("z_long", *_sma(20)),
    "ami_w": (_MOVE, *_sma(8)), "mi_w": ("z_k12", *_sma(12)), "arc_w": ("z_q50", *_sma(50)), "rc_w": ("z_q59", *_sma(59)), "srdm_w": ("z_srdm", *_sma(30)), "sma_w": ("close", *_sma(6, 2)), "high_w": ("high", *_sma(20)), "low_w": ("low", *_sma(20)), "pdm_w": ("hd", *_sma(14)), "mdm_w": ("ld", *_sma(14)),
    "pvi_c": ("ret", "1000e0", "{y} * CASE WHEN volume > v1 THEN 1 + {x} ELSE 1e0 END"), "nvi_c": ("ret", "1000e0", "{y} * CASE WHEN volume < v1 THEN 1 + {x} ELSE 1e0 END"),
    "ups_c": ("close > c1", "0e0", "CASE WHEN {x} THEN {y} + 1 ELSE 0e0 END"), "downs_c": ("close < c1", "0e0", "CASE WHEN {x} THEN {y} + 1 ELSE 0e0 END"),
    "fv_c": (_by("close - z_low10", "z_top10 - z_low10"), "0e0", "CASE WHEN {x} IS NULL THEN {y} ELSE greatest(-0.999e0, least(0.999e0, 0.66e0 * ({x} - 0.5e0) + 0.67e0 * {y})) END"),
}
# Stops: the extreme, the pace and the stop of a rising or a falling run; p is the stop before its turn is judged.
for _name, _rises in (("u", "true"), ("s", "close >= (high + low) / 2")):
    _stop = f"CASE WHEN r.{_name}_up THEN least(r.{_name}_at + r.{_name}_pace * (r.{_name}_best - r.{_name}_at), l1, coalesce(x.z_l2, l1)) ELSE greatest(r.{_name}_at + r.{_name}_pace * (r.{_name}_best - r.{_name}_at), h1, coalesce(x.z_h2, h1)) END"
    _turn = f"(CASE WHEN r.{_name}_up THEN low < ({_stop}) ELSE high > ({_stop}) END)"
    _more = f"(CASE WHEN r.{_name}_up THEN high > r.{_name}_best ELSE low < r.{_name}_best END)"
    FIRST |= {
        f"{_name}_up": ("", _rises, f"CASE WHEN {_turn} THEN NOT r.{_name}_up ELSE r.{_name}_up END"),
        f"{_name}_best": ("", f"CASE WHEN {_rises} THEN high ELSE low END", f"CASE WHEN {_turn} THEN CASE WHEN r.{_name}_up THEN low ELSE high END WHEN {_more} THEN CASE WHEN r.{_name}_up THEN high ELSE low END ELSE r.{_name}_best END"),
        f"{_name}_pace": ("", "0.02e0", f"CASE WHEN {_turn} THEN 0.02e0 WHEN {_more} THEN least(r.{_name}_pace + 0.02e0, 0.2e0) ELSE r.{_name}_pace END"),
        f"{_name}_at": ("", f"CASE WHEN {_rises} THEN low ELSE high END", f"CASE WHEN {_turn} THEN r.{_name}_best ELSE {_stop} END"),
    }
STEP |= {"z_l2": f"lag(low, 2) OVER ({_P})", "z_h2": f"lag(high, 2) OVER ({_P})"}


def _from(row: int, x: str) -> str:
    """x from a row on; before it too few values were seen."""
    return f"(CASE WHEN n >= {row} THEN {x} END)"


def _c(n: int) -> str:
    return _from(n, f"c{n}_e")


def _rsi(n: int) -> str:
    return f"({_by(f'g{n}_w', f'a{n}_w')} * 100)"


def _rsi_tv(n: int) -> str:
    return f"(CASE WHEN l{n}_w = 0 THEN CASE WHEN g{n}_w > 0 THEN 100e0 END ELSE 100 - 100 / (1 + g{n}_w / l{n}_w) END)"


_DIF = f"({_c(12)} - {_c(26)})"
# What the second recursion walks over: columns over the first one's, in two steps.
AFTER = {
    "y_turn": f"{_c(23)} - {_c(50)}", "y_dif": _DIF, "y_esa": _from(10, "t10_e"), "y_r9": _from(9, "r9_e"), "y_ami": _ref("ami_w"), "y_rc": _ref("rc_w"), "y_r7": _rsi(7), "y_r12": _rsi(12), "y_r16": _rsi(16), "y_r18": _rsi(18), "y_r120": _rsi(120), "y_r240": _rsi(240), "y_tv14": _rsi_tv(14), "y_tv7": _rsi_tv(7), "y_tv21": _rsi_tv(21),
    "y_wilder": _from(18, "CASE WHEN down18_e = 0 THEN CASE WHEN up18_e > 0 THEN 100e0 END ELSE 100 - 100 / (1 + up18_e / down18_e) END"), "y_ppo": _by(_DIF, _c(26)) + " * 100", "y_p14": _by("100 * pdm_w", "t14_w"), "y_m14": _by("100 * mdm_w", "t14_w"), "y_rsih": _by("100 * g40_w", "a40_w"), "y_m25": _from(26, "m25_e"), "y_n25": _from(26, "n25_e"),
}
AFTER2 = {
    "y_cycle": _by(f"100 * (y_turn - {_llv('y_turn', 10)})", f"{_hhv('y_turn', 10)} - {_llv('y_turn', 10)}"), "y_far": "abs(typical - y_esa)", "y_micd": f"{_ma('y_ami', 3)} - {_ma('y_ami', 8)}", "y_rccd": f"{_ma('y_rc', 21)} - {_ma('y_rc', 28)}", "y_mms": _ma("(3 * y_r12 - 2 * y_r16)", 3), "y_dx": _by("100 * abs(y_p14 - y_m14)", "y_p14 + y_m14"), "y_c12": _c(12), "y_c26": _c(26), "y_c60": _c(60),
}
SECOND = {
    "cycle_e": ("y_cycle", *_ema(3)), "dea": ("y_dif", *_ema(9)), "far_e": ("y_far", *_ema(10)), "r99_e": ("y_r9", *_ema(9)), "kd_w": ("k17_w", *_sma(6)), "d3_w": ("k9_w", *_sma(3)), "micd_w": ("y_micd", *_sma(10)), "rccd_w": ("y_rccd", *_sma(59)), "mmm_e": ("y_mms", *_ema(8)), "d60_e": ("y_c60", *_ema(60)), "wilder_e": ("y_wilder", *_ema(9)),
    "ppo_e": ("y_ppo", *_ema(9)), "d12_e": ("y_c12", *_ema(12)), "d26_e": ("y_c26", *_ema(26)), "adx_w": ("y_dx", *_sma(14)), "mm_e": ("y_m25", *_ema(13)), "nn_e": ("y_n25", *_ema(13)), "xm_e": ("m25_e", *_ema(13)), "xn_e": ("n25_e", *_ema(13)), "dd20_e": ("c20_e", *_ema(20)), "dd40_e": ("c40_e", *_ema(40)), "dd60_e": ("c60_e", *_ema(60)), "dd100_e": ("c100_e", *_ema(100)), "rr_e": ("r10_e", *_ema(10)), "rsih_e": ("y_rsih", *_ema(120)),
    "fish": ("fv_c", "CASE WHEN z_top10 > z_low10 THEN 0.5e0 * ln((1 + {x}) / (1 - {x})) ELSE 0e0 END", "CASE WHEN z_top10 > z_low10 THEN 0.5e0 * ln((1 + {x}) / (1 - {x})) + 0.5e0 * {y} ELSE {y} END"),
}
for _n, _k in ((14, 4), (10, 3), (21, 3)):
    _top, _bottom = f"((high + low) / 2 + {_k} * t{_n}_w)", f"((high + low) / 2 - {_k} * t{_n}_w)"
    _u, _d, _t = f"st{_n}_u", f"st{_n}_d", f"st{_n}_t"
    _nu, _nd = f"(CASE WHEN {_top} < r.{_u} OR c1 > r.{_u} THEN {_top} ELSE r.{_u} END)", f"(CASE WHEN {_bottom} > r.{_d} OR c1 < r.{_d} THEN {_bottom} ELSE r.{_d} END)"
    SECOND |= {_u: ("", _top, _nu), _d: ("", _bottom, _nd), _t: ("", _top, f"CASE WHEN r.{_t} = r.{_u} THEN CASE WHEN close > {_nu} THEN {_nd} ELSE {_nu} END ELSE CASE WHEN close < {_nd} THEN {_nu} ELSE {_nd} END END")}
SECOND["ut"] = ("t10_w", "CASE WHEN close > 0 THEN close - {x} ELSE close + {x} END", "CASE WHEN close > {y} AND c1 > {y} THEN greatest({y}, close - {x}) WHEN close < {y} AND c1 < {y} THEN least({y}, close + {x}) WHEN close > {y} THEN close - {x} ELSE close + {x} END")

LAST = {"y_ci": _by("typical - y_esa", f"0.015e0 * {_from(19, 'far_e')}"), "y_zero": f"(2 * {_c(12)} - {_from(23, 'd12_e')}) - (2 * {_c(26)} - {_from(51, 'd26_e')})", "y_tsi": _by(f"100 * {_from(38, 'mm_e')}", _from(38, "nn_e")), "y_fish": "CASE WHEN z_top10 > z_low10 THEN fish END"}
_D1, _Z14 = _from(61, "cycle_e"), f"({_rsi(14)} - {_ma(_rsi(14), 20)})"
LAST |= {"y_again": _by(f"100 * ({_D1} - {_llv(_D1, 10)})", f"{_hhv(_D1, 10)} - {_llv(_D1, 10)}"), "y_rd": f"{_rsi(14)} - {_ref(_rsi(14))}", "y_rz": _by(_Z14, f"CASE WHEN {f._f('stddev_pop', _rsi(14), 20)} >= 1e-10 THEN {f._f('stddev_pop', _rsi(14), 20)} END")}
LAST |= {"y_k14": _by(f"100 * (y_tv14 - {_llv('y_tv14', 14)})", f"{_hhv('y_tv14', 14)} - {_llv('y_tv14', 14)}")}
THIRD = {"again_e": ("y_again", *_ema(3)), "wt_e": ("y_ci", *_ema(21)), "zero_e": ("y_zero", *_ema(9)), "tsi_e": ("y_tsi", *_ema(13)), "slow_w": ("d3_w", *_sma(3)), "triple20": ("dd20_e", *_ema(20)), "triple40": ("dd40_e", *_ema(40))}

_WT = _from(39, "wt_e")
_EXTREME = {n: (_hhv(f"y_{n}", k), _llv(f"y_{n}", k)) for n, k in (("r7", 7), ("r120", 120), ("r240", 240))}
_BIAS, _ROC = _by(f"close - {_ma('close', 12)}", _ma("close", 12)) + " * 100", f"({_by('close - c24', 'c24')} * 100)"
_CCI = _by("typical - t14", f"0.015e0 * {f._deviation('typical', 't14', 14)}") + " / 100"
_MULTI = f"(50 * (0 * y_r7 + 0 * {_BIAS} + 0 * {_CCI} + {_ROC} / (abs({_ROC}) + 2) + 1))"


def _but_first(x: str) -> str:
    return f"CASE WHEN count({x}) OVER ({_P} ROWS UNBOUNDED PRECEDING) > 1 THEN {x} END"


def _within(name: str, flat: str) -> str:
    top, low = _EXTREME[name]
    return f"CASE WHEN {top} = {low} THEN {flat} WHEN {top} IS NULL THEN NULL ELSE (y_{name} - {low}) / ({top} - {low}) * 100 END"


_DEA = _from(34, "dea")
WH6 = {
    "DBCD_DBCD": "dbcd_w", "DBCD_MM": _ma("dbcd_w", 5), "DDI_ADDI": "addi_w", "DDI_AD": _ma("addi_w", 5), "KD_K": "k17_w", "KD_D": "kd_w", "KDJ_K": "k9_w", "KDJ_D": "d3_w", "KDJ_J": "3 * k9_w - 2 * d3_w", "LON_LON": "lon10_w - lon20_w", "LON_LONGMA": _ma("(lon10_w - lon20_w)", 10), "LON_LONGT": "lon10_w - lon20_w",
    "MACD_DIFF": "y_dif", "MACD_DEA": _DEA, "MACD_MACD": f"2 * (y_dif - {_DEA})", "MASS_MASS": _sum("(" + _by("y_r9", _from(17, "r99_e")) + ")", 25), "MI_MI": "mi_w", "MICD_DIF": "y_micd", "MICD_MICD": "micd_w", "RC_ARC": "arc_w", "RCCD_DIF": "y_rccd", "RCCD_RCCD": "rccd_w", "RSI_RSI1": _rsi(8), "RSI_RSI2": _rsi(14), "SLOWKD_K": "d3_w", "SLOWKD_D": "slow_w", "SRDM_ASRDM": "srdm_w",
    "STOCHASTIC_RSI_RSI_BASE": "y_r7", "STOCHASTIC_RSI_STOCH_RSI_RAW": _within("r7", "50e0"), "ZLJC_JCS": "z_jcs", "ZLJC_JCM": _ma("z_jcs", 12), "ZLJC_JCL": _ma("z_jcs", 26), "ZLMM_MMS": "y_mms", "ZLMM_MMM": "CASE WHEN count(y_mms) OVER (" + _P + ") >= 8 THEN mmm_e END", "ZLMM_MML": _ma("(3 * y_r18 - 2 * y_r12)", 5), "MV_MV_2": "v10_w", "MV_MV_3": "v20_w", "VRSI_VRSI": _by("vg_w", "va_w") + " * 100",
    "DEMA_DEMA": f"2 * y_c60 - {_from(119, 'd60_e')}", "EMA_MA1": _c(20), "EMA2_MA1": _c(10), "SMA_SMA": "sma_w", **{f"PUBU_PB{i}": f"({_c(n)} + {_ma('close', 2 * n)} + {_ma('close', 4 * n)}) / 3" for i, n in enumerate((4, 6, 9, 13, 18, 24), 1)}, "SAR_SARLINE": "u_at", "SAR1_SARLINE": "u_at", "RSIS_RSIS1": _within("r120", "0e0"), "RSIS_RSIS2": _within("r240", "0e0"),
    "u_a8b37c90_MULTI": f"CASE WHEN {_MULTI} IS NOT NULL THEN greatest(least({_MULTI}, 100), 0) END", "RSI_WILDER_RSI1": "y_wilder", "RSI_WILDER_RSI2": _from(26, "wilder_e"), "u_dcb52af4_MID": _c(20), "u_dcb52af4_UPPER": f"{_c(20)} + 1.5e0 * {_ma('tr', 10)}", "u_dcb52af4_LOWER": f"{_c(20)} - 1.5e0 * {_ma('tr', 10)}",
}
INDICATOR = {"rsi_diff": _but_first("y_rd"), "rsi_zscore_20": _but_first("y_rz"), "ppo": _by(f"{_c(12)} - {_c(26)}", _c(26)), "macd_hist_diff": f"(y_dif - {_DEA}) - lag(y_dif - {_DEA}) OVER ({_P})"}
EXCEL = {
    "ER_bull_power_20": "high - c20_e", "ER_bear_power_20": "low - c20_e", "TII_signal_9": "tii_e", "PO_9_26": "100 * " + _by("c9_e - c26_e", "c26_e"), "PAC_upper_20": "high_w", "PAC_lower_20": "low_w", "ZLMACD_20_100": "(2 * c20_e - dd20_e) - (2 * c100_e - dd100_e)", "TYPMA1_10": "t10_e", "TYPMA2_30": "t30_e", "SROC_13_21": _by(f"c13_e - lag(c13_e, 21) OVER ({_P})", f"lag(c13_e, 21) OVER ({_P})"),
    "EXPMA_12": "c12_e", "EXPMA_50": "c50_e", "DEMA_60": "2 * c60_e - dd60_e", "APZ_upper_10_20": "dd20_e + 2 * rr_e", "APZ_lower_10_20": "dd20_e - 2 * rr_e", "KC_upper_14_20": f"c20_e + 2 * {_ma('tr0', 14)}", "KC_lower_14_20": f"c20_e - 2 * {_ma('tr0', 14)}", "RSIH_40_120": "y_rsih - rsih_e", "TRIX_20": _by(f"triple20 - {_ref('triple20')}", _ref("triple20")), "WC_ema20": "x20_e", "WC_ema40": "x40_e",
    "TSI_25_13": "100 * " + _by("xm_e", "xn_e"), "TEMA_20": "3 * c20_e - 3 * dd20_e + triple20", "TEMA_40": "3 * c40_e - 3 * dd40_e + triple40", "PVO_12_26": _by("v12_e - v26_e", "v26_e"), "MACDVOL_20_40": "v20_e - v40_e", "MACDVOL_signal_10": _ma("(v20_e - v40_e)", 10), "FI_13": "f13_e", "SROCVOL_20_10": _by(f"v20_e - lag(v20_e, 10) OVER ({_P})", f"lag(v20_e, 10) OVER ({_P})"),
}
TV = {
    **{f"supertrend_{n}_{k}_line": f"st{n}_t" for n, k in ((14, 4), (10, 3), (21, 3))}, **{f"supertrend_{n}_{k}_dir": f"CASE WHEN st{n}_t = st{n}_d THEN 1e0 WHEN n = 1 THEN 1e0 ELSE -1e0 END" for n, k in ((14, 4), (10, 3), (21, 3))}, "wavetrend_wt1_10_21": _WT, "wavetrend_wt2_4": _ma(_WT, 4), "wavetrend_hist": f"{_WT} - {_ma(_WT, 4)}", "utbot_trailing_stop_10_1": "ut",
    "utbot_signal_10_1": f"CASE WHEN n = 1 THEN 0e0 WHEN close > ut AND c1 <= {_ref('ut')} THEN 1e0 WHEN close < ut AND c1 >= {_ref('ut')} THEN -1e0 ELSE 0e0 END", "macd_custom_macd_12_26": "y_dif", "macd_custom_signal_9": _DEA, "macd_custom_hist": f"y_dif - {_DEA}", **{f"ema_{n}": _c(n) for n in (8, 21, 34, 55)}, "close_to_ema_21": f"close / {_c(21)} - 1", "close_to_ema_55": f"close / {_c(55)} - 1",
    "ema_8_21_gap": f"{_c(8)} / {_c(21)} - 1", "ema_21_55_gap": f"{_c(21)} / {_c(55)} - 1", "psar_002_02": "s_at", "psar_dir": "CASE WHEN close >= s_at THEN 1e0 ELSE -1e0 END", "atr_14": "t14_w", "atr_pct_14": _by("t14_w", "close"), "natr_14": _by("100 * t14_w", "close"), "chandelier_long_22_3": f"{_hhv('high', 22)} - 3 * t14_w", "chandelier_short_22_3": f"{_llv('low', 22)} + 3 * t14_w",
    "rsi_7": "y_tv7", "rsi_14": "y_tv14", "rsi_21": "y_tv21", "rsi_14_ma_9": _ma("y_tv14", 9), "stoch_rsi_k_14": "y_k14", "stoch_rsi_d_3": _ma("y_k14", 3), "schaff_trend_cycle": _from(72, "again_e"), "ppo_12_26": "y_ppo", "ppo_signal_9": _from(34, "ppo_e"), "ppo_hist": f"y_ppo - {_from(34, 'ppo_e')}", "zero_lag_macd": "y_zero", "zero_lag_signal": _from(59, "zero_e"), "tsi_25_13": "y_tsi", "tsi_signal_13": _from(50, "tsi_e"), "fisher_10": "y_fish", "fisher_trigger": _ref("y_fish"),
    "dmi_plus_14": "y_p14", "dmi_minus_14": "y_m14", "adx_14": "adx_w", "obv_ema_20": _from(20, "obv_e"), "chaikin_osc_3_10": f"{_from(3, 'adl3_e')} - {_from(10, 'adl10_e')}", "force_index_13": _from(14, "f13_e"), "pvi": "pvi_c", "nvi": "nvi_c", "consecutive_up_bars": "ups_c", "consecutive_down_bars": "downs_c",
}
BY_HAND = {**{f"wh6_{k}": v for k, v in WH6.items()}, **{f"indicator_py_{k}": v for k, v in INDICATOR.items()}, **{f"excel_{k}": v for k, v in EXCEL.items()}, **{f"tv_{k}": v for k, v in TV.items()}}


def _walk(name: str, source: str, states: dict[str, tuple[str, str, str]]) -> str:
    first = ", ".join(f"{a.replace('{x}', f'({x})')} AS {s}" for s, (x, a, _) in states.items())
    later = ", ".join(b.replace("{x}", f"({x})").replace("{y}", f"r.{s}") for s, (x, _, b) in states.items())
    return f"{name} AS (SELECT symbol, timeframe, n, {first} FROM {source} WHERE n = 1 UNION ALL SELECT x.symbol, x.timeframe, x.n, {later} FROM {name} r JOIN {source} x ON x.symbol = r.symbol AND x.timeframe = r.timeframe AND x.n = r.n + 1)"


def _more(source: str, made: dict[str, str]) -> str:
    return f"(SELECT *, {', '.join(f'{v} AS {k}' for k, v in made.items())} FROM {source})"


def sql(bars: str, columns: list[str], wrap) -> str:
    outer = ", ".join(f"{wrap(c)} AS {c}" for c in columns)
    inner = ", ".join(f"{BY_HAND[c]} AS {c}" for c in columns)
    joined = lambda a, r: f"(SELECT * FROM {a} JOIN {r} USING (symbol, timeframe, n))"
    return f"""WITH RECURSIVE bars AS ({bars}), b AS ({f.B}), d AS ({f.D}), e AS ({f.E}), w1 AS MATERIALIZED {_more(_more("e", STEP), STEP2)}, {_walk("r1", "w1", FIRST)},
w2 AS MATERIALIZED {_more(_more(joined("w1", "r1"), AFTER), AFTER2)}, {_walk("r2", "w2", SECOND)},
w3 AS MATERIALIZED {_more(joined("w2", "r2"), LAST)}, {_walk("r3", "w3", THIRD)}
SELECT symbol, timeframe, trade_time, {outer} FROM (SELECT symbol, timeframe, trade_time, {inner} FROM {joined("w3", "r3")}) q"""
