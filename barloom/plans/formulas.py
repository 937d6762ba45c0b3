"""SQL of many columns as their formulas are told, for a second engine.

Nothing here knows the expression graph: each column is written by hand, so a wrong
formula, parameter or null rule in the graph shows as a difference.  `b` has the bars and
their lags, `d` what one row and the one before give, `e` averages that others stand on,
`g` what stands on these, `h` means of that.
"""

from __future__ import annotations

_P = "PARTITION BY symbol, timeframe ORDER BY trade_time"


def _f(fn: str, x: str, n: int) -> str:
    """fn over the last n rows, if all of them have x."""
    return f"(CASE WHEN count({x}) OVER ({_P} ROWS {n - 1} PRECEDING) = {n} THEN {fn}({x}) OVER ({_P} ROWS {n - 1} PRECEDING) END)"


def _ma(x: str, n: int) -> str:
    return _f("avg", x, n)


def _sum(x: str, n: int) -> str:
    return _f("sum", x, n)


def _hhv(x: str, n: int) -> str:
    return _f("max", x, n)


def _llv(x: str, n: int) -> str:
    return _f("min", x, n)


def _ref(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER ({_P})"


def _by(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


def _both(fn: str, a: str, b: str) -> str:
    """greatest or least of two, missing if either is."""
    return f"(CASE WHEN ({a}) IS NOT NULL AND ({b}) IS NOT NULL THEN {fn}({a}, {b}) END)"


def _weights(x: str, n: int) -> str:
    """Linearly weighted mean of the last n rows."""
    return f"(CASE WHEN count({x}) OVER ({_P} ROWS {n - 1} PRECEDING) = {n} THEN list_sum(list_transform(list({x}) OVER ({_P} ROWS {n - 1} PRECEDING), lambda v, i: v * i)) / {n * (n + 1) // 2} END)"


def _deviation(x: str, mean: str, n: int) -> str:
    return f"(CASE WHEN {mean} IS NOT NULL THEN list_avg(list_transform(list({x}) OVER ({_P} ROWS {n - 1} PRECEDING), lambda v: abs(v - {mean}))) END)"


def _running(x: str) -> str:
    """The sum of all so far, missing where x is."""
    return f"(CASE WHEN {x} IS NOT NULL THEN sum({x}) OVER ({_P} ROWS UNBOUNDED PRECEDING) END)"


def _rank(x: str, n: int) -> str:
    """Rank of the last of n, ties averaged, as a share of n."""
    return f"(CASE WHEN count({x}) OVER ({_P} ROWS {n - 1} PRECEDING) = {n} THEN (list_sum(list_transform(list({x}) OVER ({_P} ROWS {n - 1} PRECEDING), lambda v: CASE WHEN v < {x} THEN 1e0 WHEN v = {x} THEN 0.5e0 ELSE 0e0 END)) + 0.5e0) / {n} END)"


def _place(x: str, fn: str, n: int) -> str:
    """Place, from 1, of the first of the best of the last n."""
    return f"(CASE WHEN count({x}) OVER ({_P} ROWS {n - 1} PRECEDING) = {n} THEN list_position(list({x}) OVER ({_P} ROWS {n - 1} PRECEDING), {fn}({x}) OVER ({_P} ROWS {n - 1} PRECEDING)) END)"


def _line(x: str, n: int) -> str:
    """Least-squares line through the last n rows, at the last."""
    over = f"OVER ({_P} ROWS {n - 1} PRECEDING)"
    return f"(CASE WHEN count({x}) {over} = {n} THEN regr_intercept({x}, n) {over} + n * regr_slope({x}, n) {over} END)"


def _alma(x: str, n: int, offset: float, sigma: float) -> str:
    """Mean of the last n rows with the weights of a bell that stands at offset."""
    bell = f"exp(-pow({{}} - {offset}e0 * {n - 1}, 2) / (2 * pow({n} / {sigma}e0, 2)))"
    return f"(CASE WHEN count({x}) OVER ({_P} ROWS {n - 1} PRECEDING) = {n} THEN list_sum(list_transform(list({x}) OVER ({_P} ROWS {n - 1} PRECEDING), lambda v, i: v * {bell.format('(i - 1)')})) / list_sum(list_transform(range({n}), lambda i: {bell.format('i')})) END)"


_SIGNED = "(16 * (close - c1 + (close - open) / 2 + c1 - o1))"
_LAGS = ", ".join(f"lag(close, {n}) OVER w AS c{n}" for n in (1, 3, 5, 6, 9, 10, 12, 20, 24, 100))
B = f"SELECT *, row_number() OVER w AS n, lag(open) OVER w AS o1, lag(high) OVER w AS h1, lag(low) OVER w AS l1, lag(volume) OVER w AS v1, lag(open_interest) OVER w AS i1, lag(volume, 12) OVER w AS v12, {_LAGS} FROM bars WINDOW w AS ({_P})"
D = f"""SELECT *, (high + low + close) / 3 AS typical,
  CASE WHEN c1 IS NOT NULL THEN greatest(high - low, abs(c1 - high), abs(c1 - low)) END AS tr, CASE WHEN c1 IS NULL THEN high - low ELSE greatest(high - low, abs(high - c1), abs(low - c1)) END AS tr0,
  CASE WHEN open <= o1 THEN 0e0 ELSE {_both("greatest", "high - open", "open - o1")} END AS dtm, CASE WHEN open >= o1 THEN 0e0 ELSE {_both("greatest", "open - low", "o1 - open")} END AS dbm,
  CASE WHEN high + low <= h1 + l1 THEN 0e0 ELSE {_both("greatest", "abs(high - h1)", "abs(low - l1)")} END AS dmz, CASE WHEN high + low >= h1 + l1 THEN 0e0 ELSE {_both("greatest", "abs(high - h1)", "abs(low - l1)")} END AS dmf,
  CASE WHEN high - h1 > 0 AND high - h1 > l1 - low THEN high - h1 ELSE 0e0 END AS hd, CASE WHEN l1 - low > 0 AND l1 - low > high - h1 THEN l1 - low ELSE 0e0 END AS ld,
  CASE WHEN v1 = 0 THEN CASE WHEN (volume - v1) * (h1 - l1) > 0 THEN '-Infinity'::DOUBLE END ELSE close - c1 - (volume - v1) * (h1 - l1) / v1 END AS qhl,
  CASE WHEN close > c1 THEN 1e0 ELSE 0e0 END AS up, CASE WHEN close > c1 THEN volume WHEN close < c1 THEN -volume ELSE 0e0 END AS signed,
  close - least(low, c1) AS pressure0, close - {_both("least", "low", "c1")} AS pressure, {_both("greatest", "high", "c1")} - {_both("least", "low", "c1")} AS span, greatest(high, coalesce(c1, high)) - least(low, coalesce(c1, low)) AS span0,
  {_by("close - c1", "c1")} AS ret, {_by("2 * close - low - high", "high - low")} AS clv, (high + low) / 2 AS mid, (3 * close + low + open + high) / 6 AS dk,
  abs(high - c1) AS aa, abs(low - c1) AS bb, abs(high - l1) AS cc, abs(c1 - o1) AS dd, {_by("close - c100", "c100")} AS p100, {_by("volume - v1", "v1")} AS grown, close - c1 AS moved1
  FROM b"""
E = f"""SELECT *, CASE WHEN typical > {_ref("typical")} THEN typical * volume ELSE 0e0 END AS flow_up, CASE WHEN typical < {_ref("typical")} THEN typical * volume ELSE 0e0 END AS flow_down,
  {_ma("close", 20)} AS m20, {_f("stddev_pop", "close", 20)} AS s20, {_ma("typical", 14)} AS t14, {_ma("typical", 20)} AS t20, {_ma("typical", 100)} AS t100, {_ma("volume", 20)} AS v20,
  ({_ma("close", 3)} + {_ma("close", 6)} + {_ma("close", 12)} + {_ma("close", 24)}) / 4 AS bbi, {_by(f"{_sum('hd', 14)} * 100", _sum("tr", 14))} AS pdi, {_by(f"{_sum('ld', 14)} * 100", _sum("tr", 14))} AS mdi,
  {_hhv("high", 14)} AS h14, {_llv("low", 14)} AS l14, {_sum("dtm", 23)} AS stm, {_sum("dbm", 23)} AS sbm, {_sum("dmz", 13)} AS sz, {_sum("dmf", 13)} AS sf, close - {_ma("close", 40)} AS off, {_ma("mid", 5)} - {_ma("mid", 34)} AS ao,
  {_by("mid - lag(mid) OVER (" + _P + ")", "1e0")} AS moved, {_hhv("high", 20)} AS h20, {_llv("low", 20)} AS l20, {_weights("close", 10)} AS w10, {_weights("close", 21)} AS w21,
  {", ".join(f"{_ma('close', n)} AS m{n}" for n in (5, 10, 24, 25, 30, 40, 50, 60, 120))}, {_ma("volume", 25)} AS q25, {_ref("typical")} AS tp1, sum(signed) OVER ({_P} ROWS UNBOUNDED PRECEDING) AS obv, CASE WHEN n >= 12 THEN sum(up) OVER ({_P} ROWS 11 PRECEDING) / 12 * 100 END AS psy,
  {_by(f"{_ma('volume', 12)} - {_ma('volume', 26)}", _ma("volume", 12))} * 100 AS vosc, {_ma("close", 10)} - {_ma("close", 50)} AS ddd, {_f("stddev_pop", "close", 50)} AS s50, {_ma("dmz", 10)} AS admz, {_ma("dmf", 10)} AS admf,
  CASE WHEN n >= 125 THEN {_by(f"sum(CASE WHEN close >= c1 THEN 1e0 ELSE 0e0 END) OVER ({_P} ROWS 124 PRECEDING)", f"sum(CASE WHEN close < c1 THEN 1e0 ELSE 0e0 END) OVER ({_P} ROWS 124 PRECEDING)")} END AS zd,
  ({" + ".join(f"{20 - k} * {_ref('dk', k)}" for k in range(19))} + {_ref("dk", 20)}) / 210 AS dkx, {_by("100 * (close - " + _ma("close", 24) + ")", _ma("close", 24))} * (1 + {_ma("grown", 5)}) AS short,
  {_by(_hhv("close", 22) + " - low", _hhv("close", 22))} * 100 AS wvf, ({_by("close", _hhv("close", 14))} - 1) * 100 AS fall, {_ma("tr0", 20)} AS reach
  FROM d"""
G = f"""SELECT *, {_by(_sum(_both("greatest", "0e0", "high - tp1"), 26), _sum(_both("greatest", "0e0", "tp1 - low"), 26))} * 100 AS cr, {_ma(_by("abs(mdi - pdi)", "mdi + pdi") + " * 100", 6)} AS adx, 100 * {_by("close - l14", "h14 - l14")} AS k14,
  2 * w10 - w21 AS hull, close - ((h20 + l20) / 2 + m20) / 2 AS squeezed FROM e"""
H = f"SELECT *, {', '.join(f'{_ma("cr", n)} AS cr{n}' for n in (5, 10, 20, 40))} FROM g"


def _uo(pressure: str, span: str) -> str:
    part = lambda n: _by(_sum(pressure, n), _sum(span, n))
    return f"100 * (4 * {part(7)} + 2 * {part(14)} + {part(28)}) / 7"


_MFI = f"(CASE WHEN {_sum('flow_down', 14)} = 0 THEN CASE WHEN {_sum('flow_up', 14)} > 0 THEN 100e0 END ELSE 100 - 100 / (1 + {_sum('flow_up', 14)} / nullif({_sum('flow_down', 14)}, 0)) END)"
_QUP, _QDOWN = "(CASE WHEN qhl > 0 THEN qhl ELSE 0e0 END)", "(CASE WHEN isinf(qhl) THEN NULL WHEN qhl < 0 THEN qhl ELSE 0e0 END)"

WH6 = {
    "ADTM_ADTM": f"CASE WHEN stm > sbm THEN {_by('stm - sbm', 'stm')} WHEN stm = sbm THEN 0e0 ELSE {_by('stm - sbm', 'sbm')} END",
    "ARBR_AR": _by(_sum("high - open", 26), _sum("open - low", 26)) + " * 100", "ARBR_BR": _by(_sum(_both("greatest", "0e0", "high - c1"), 26), _sum(_both("greatest", "0e0", "c1 - low"), 26)) + " * 100",
    "ATR_TR": "tr", "ATR_ATR": _ma("tr", 14), "B3612_B36": f"{_ma('close', 3)} - {_ma('close', 6)}", "B3612_B612": f"{_ma('close', 6)} - {_ma('close', 12)}",
    **{f"BIAS_BIAS{i}": _by(f"close - {_ma('close', n)}", _ma("close", n)) + " * 100" for i, n in ((1, 6), (2, 12), (3, 20))},
    "CCI_CCI": _by("typical - t100", _deviation("typical", "t100", 100)) + " / 0.015e0", "DDI_DDI": f"{_by('sz', 'sz + sf')} - {_by('sf', 'sz + sf')}", "DMA_DDD": f"{_ma('close', 10)} - {_ma('close', 50)}",
    "DMI_PDI": "pdi", "DMI_MDI": "mdi", "DMI_ADX": _ma(_by("abs(mdi - pdi)", "mdi + pdi") + " * 100", 6), "MFI_MFI": _MFI, "MFI_MFI_2": _MFI, "MTM_MTM": "close - c6", "MTM_MTMMA": _ma("(close - c6)", 6),
    "PRICEOSC_PRICEOSC": _by(f"{_ma('close', 12)} - {_ma('close', 26)}", _ma("close", 12)) + " * 100", "PSY_PSY": f"CASE WHEN n >= 12 THEN sum(up) OVER ({_P} ROWS 11 PRECEDING) / 12 * 100 END",
    "QHLSR_QHL10": _by(_sum(_QUP, 10), f"{_sum(_QUP, 10)} + abs({_sum(_QDOWN, 10)})"), "ROC_ROC": _by("close - c24", "c24") + " * 100", "ROC_ROC_B": f"({_by('close - c24', 'c24')} * 100) / (abs({_by('close - c24', 'c24')} * 100) + 8)",
    "SRMI_SRMI": f"CASE WHEN close < c9 THEN {_by('close - c9', 'c9')} WHEN close = c9 THEN 0e0 ELSE {_by('close - c9', 'close')} END", "WR_WR": _by("-100 * (h14 - close)", "h14 - l14"),
    "OBV_OBV": f"sum(signed) OVER ({_P} ROWS UNBOUNDED PRECEDING)", "VOSC_VOSC": _by(f"{_ma('volume', 12)} - {_ma('volume', 26)}", _ma("volume", 12)) + " * 100",
    "VR_VR": _by(_sum("(CASE WHEN close > c1 THEN volume ELSE 0e0 END)", 25), _sum("(CASE WHEN close <= c1 THEN volume ELSE 0e0 END)", 25)) + " * 100", "VROC_VROC": _by("volume - v12", "v12") + " * 100", "WVAD_WVAD": _by("close - open", "high - low") + " * volume",
    "BBI_BBI": "bbi", "BBIBOLL_UPR": f"bbi + 3 * {_f('stddev_pop', 'bbi', 10)}", "CDP_AH": "typical + (h1 - l1)", "CDP_NL": "2 * typical - high", "ENV_UPPER": f"{_ma('close', 14)} * 1.06e0", "HCL_MAH": _ma("high", 10),
    "MIKE_WR": f"typical + (typical - {_llv('low', 12)})", "MIKE_SS": f"2 * {_llv('low', 12)} - {_hhv('high', 12)}", "FIBONACCI_BANDS_FIBONACCI_BANDS_4": f"m20 + 3 * {_ma('tr', 20)}", "FIBONACCI_BANDS_FIBONACCI_BANDS_5": f"m20 - {_ma('tr', 20)}",
    "VWMA_VWMA3": _by(_sum("(close * volume)", 50), _sum("volume", 50)), "Z_SCORE_Z_SCORE": _by("close - m20", "s20"), "u_8b96f436_BBW": _by("4 * s20", "m20"), "u_dc9bfffe_UO": _uo("pressure", "span"),
    "u_495a23e5_UPPER": f"m20 + 2 * {_ma('(high - low)', 10)}", "u_dcb52af4_AAA": _ma("tr", 10), "u_a4f8ae15_MIDDLE": "(h20 + l20) / 2", "VOLATILITY_u_c40446c0": f"{_f('stddev_pop', 'ret', 60)} * 100",
}
_ASI = f"16 * {_by('close - c1 + (close - open) / 2 + c1 - o1', 'CASE WHEN aa > bb AND aa > cc THEN aa + bb / 2 + dd / 4 WHEN bb > cc AND bb > aa THEN bb + aa / 2 + dd / 4 ELSE cc + dd / 4 END')} * {_both('greatest', 'aa', 'bb')}"
_ALWAYS = lambda sign: f"sum(CASE WHEN qhl {sign} 0 THEN 1 ELSE 0 END) OVER ({_P} ROWS 4 PRECEDING) = 5"
WH6 |= {
    "ADTM_ADTMMA": _ma("(CASE WHEN stm > sbm THEN (stm - sbm) / nullif(stm, 0) WHEN stm = sbm THEN 0e0 ELSE (stm - sbm) / nullif(sbm, 0) END)", 8), "ASI_ASI": _running(f"({_ASI})"),
    "CR_CR": "cr", "CR_CRMA1": _ref("cr5", 3), "CR_CRMA2": _ref("cr10", 5), "CR_CRMA3": _ref("cr20", 9), "CR_CRMA4": _ref("cr40", 17), "DMA_AMA": _ma("ddd", 10), "DMI_ADXR": f"(adx + {_ref('adx', 6)}) / 2", "DPO_DPO": f"close - {_ref('m20', 11)}",
    "MI_A": "close - c12", "PSY_PSYMA": _ma("psy", 6), "QHLSR_QHL5": f"CASE WHEN n >= 5 AND {_ALWAYS('>')} THEN 1e0 WHEN n >= 5 AND {_ALWAYS('<')} THEN 0e0 ELSE {_by(_sum(_QUP, 5), f'{_sum(_QUP, 5)} + abs({_sum(_QDOWN, 5)})')} END",
    **{f"ROC_ROCMA{mark}": _ma(f"({_by('close - c24', 'c24')} * 100)", n) for mark, n in (("", 20), ("_2", 24))}, "ROC_ROC_2": _by("close - c24", "c24") + " * 100",
    "SHORT_SHORT": "short", "SHORT_SHORTMA": _ma("short", 5), "SHORT_SHORTT": "short", "SRDM_SRDM": f"CASE WHEN admz > admf THEN {_by('admz - admf', 'admz')} WHEN admz = admf THEN 0e0 ELSE {_by('admz - admf', 'admf')} END", "ZDZB_B": _ma("zd", 5), "ZDZB_D": _ma("zd", 20),
    "AD_AD": _running("(clv * volume)"), "CCL_CCL": "open_interest", "CJL_CJL": "volume", "MV_MV": "volume", "OBV_OBVMA": _ma("obv", 20), "PVT_PVT": _running("(ret * volume)"), "VOSC_OBVMA": _ma("vosc", 20),
    "WAD_WAD": _running("(CASE WHEN close > c1 THEN close - least(c1, low) WHEN close < c1 THEN close - greatest(c1, high) ELSE 0e0 END)"),
    "u_78c25b4e_u_273a581d": "m25", "u_78c25b4e_u_2da16149": "q25", "u_78c25b4e_DT1": f"CASE WHEN m25 > {_ref('m25')} AND q25 > {_ref('q25')} THEN m25 END", "u_78c25b4e_KT1": f"CASE WHEN m25 < {_ref('m25')} AND q25 < {_ref('q25')} THEN m25 END",
    "BAR_BAR": "open", "CLOSE_CLOSE": "close", "HIGH_HIGH": "high", "LOW_LOW": "low", "OPEN_OPEN": "open", "SP_SP": "close", "u_d6d18ecd_u_d6d18ecd": "close", "MYFORCAST_MYFORCAST": _line("c1", 10),
    "BBIBOLL_BBIBOLL": "bbi", "BBIBOLL_DWN": f"bbi - 3 * {_f('stddev_pop', 'bbi', 10)}", "BOLL_MID": _ma("close", 26), "BOLL_TOP": f"{_ma('close', 26)} + 1.5e0 * {_f('stddev_pop', 'close', 26)}", "BOLL_BOTTOM": f"{_ma('close', 26)} - 1.5e0 * {_f('stddev_pop', 'close', 26)}",
    "CDP_CDP": "typical", "CDP_AL": "typical - (h1 - l1)", "CDP_NH": "2 * typical - low", "DKX_B": "dkx", "DKX_D": _ma("dkx", 10), "ENV_LOWER": f"{_ma('close', 14)} * 0.94e0", "HCL_MAL": _ma("low", 10), "HCL_MAC": "m10", "MA_MA1": "m10", "WTD_WTD": "m30",
    "MIKE_MR": f"typical + ({_hhv('high', 12)} - {_llv('low', 12)})", "MIKE_MS": f"typical - ({_hhv('high', 12)} - {_llv('low', 12)})", "MIKE_SR": f"2 * {_hhv('high', 12)} - {_llv('low', 12)}", "MIKE_WS": f"typical - ({_hhv('high', 12)} - typical)",
    **{c: "h20" for c in ("u_6ae5cc5a_HH", "u_68173cb3_H20", "u_a4f8ae15_UPPER")}, **{c: "l20" for c in ("u_6ae5cc5a_LL", "u_68173cb3_L20", "u_a4f8ae15_LOWER")}, "u_72bedb5a_MA15": _ma("close", 15), "u_d6d18ecd_MA1": "m60",
    **{c: "m5" for c in ("u_5c41ea6d_MA5", "u_9a0c2be9_MA5", "u_6f963dfa_MA5")}, **{c: "m10" for c in ("u_5c41ea6d_MA10", "u_9a0c2be9_MA10", "u_6f963dfa_MA10")}, **{c: "m30" for c in ("u_72bedb5a_MA30", "u_5c41ea6d_MA30", "u_21e0022b_MA1", "u_9a0c2be9_MA30")},
    "FIBONACCI_BANDS_FIBONACCI_BANDS": "m20", **{f"FIBONACCI_BANDS_FIBONACCI_BANDS_{i}": f"m20 + {k} * {_ma('tr', 20)}" for i, k in ((2, 1), (3, 2), (6, -2), (7, -3))},
    "u_a8b37c90_u_a8b37c90": "50e0", "u_a8b37c90_u_a8b37c90_2": "79e0", "u_a8b37c90_u_a8b37c90_3": "21e0", "u_495a23e5_MID": "m20", "u_495a23e5_LOWER": f"m20 - 2 * {_ma('(high - low)', 10)}", "u_dcb52af4_TR": "tr",
}
INDICATOR = {
    **{f"ret_{n}": _by(f"close - c{n}", f"c{n}") for n in (1, 3, 5, 10, 20)}, **{f"momentum_{n}": f"close - c{n}" for n in (5, 10, 20)},
    **{f"close_to_ma{n}": _by(f"close - {_ma('close', n)}", _ma("close", n)) for n in (5, 10, 60)}, "ma5_ma20_gap": _by(f"{_ma('close', 5)} - m20", "m20"),
    "hl_pct": _by("high - low", "close"), "volatility_20": _f("stddev_samp", "ret", 20), "break_high_20": f"CASE WHEN close > {_ref('h20')} THEN 1e0 ELSE 0e0 END", "pos_in_range_20": _by("close - l20", "h20 - l20"), "close_pos": _by("close - low", "high - low"),
    "vol_ratio_20": _by("volume", "v20"), "volume_diff": "volume - v1", "oi_diff": "open_interest - i1", "price_up_vol_up": "CASE WHEN close > c1 AND volume > v1 THEN 1e0 ELSE 0e0 END", "price_down_oi_up": "CASE WHEN close < c1 AND open_interest > i1 THEN 1e0 ELSE 0e0 END",
}
INDICATOR |= {
    **{f"ma{n}_slope": f"{_by(f'm{n}', _ref(f'm{n}'))} - 1" for n in (5, 10, 20, 40, 60, 120)}, **{f"close_to_ma{n}": _by(f"close - m{n}", f"m{n}") for n in (20, 40, 120)}, **{f"ma{a}_ma{b}_gap": _by(f"m{a} - m{b}", f"m{b}") for a, b in ((5, 10), (10, 20), (20, 40), (20, 60), (40, 120))},
    "tr_ratio": _by("tr0", "close"), "atr_norm": _by(f"coalesce({_ma('tr', 14)}, {_ma('tr0', 14)})", "close"), "volatility_5": _f("stddev_samp", "ret", 5), "volatility_10": _f("stddev_samp", "ret", 10), "vol_ratio_5_20": _by(_f("stddev_samp", "ret", 5), _f("stddev_samp", "ret", 20)),
    "break_low_20": f"CASE WHEN close < {_ref('l20')} THEN 1e0 ELSE 0e0 END", "dist_prev_high_20": _by(f"close - {_ref('h20')}", _ref("h20")), "dist_prev_low_20": _by(f"close - {_ref('l20')}", _ref("l20")), "pos_in_range_60": _by(f"close - {_llv('low', 60)}", f"{_hhv('high', 60)} - {_llv('low', 60)}"),
    "boll_pct_b": f"0.5e0 + {_by('close - m20', 's20')} / 4", "boll_width": _by("4 * s20", "m20"), "zscore_close_20": _by("close - m20", "s20"), "zscore_volume_20": _by("volume - v20", _f("stddev_pop", "volume", 20)), "close_rank_60": _rank("close", 60), "volume_rank_60": _rank("volume", 60),
    "vol_ratio_5": _by("volume", _ma("volume", 5)), "oi_ratio_5": _by("open_interest", _ma("open_interest", 5)), "price_down_vol_up": "CASE WHEN close < c1 AND volume > v1 THEN 1e0 ELSE 0e0 END", "price_up_oi_up": "CASE WHEN close > c1 AND open_interest > i1 THEN 1e0 ELSE 0e0 END",
}
EXCEL = {
    "TII_40_21": "100 * " + _by(_sum("(CASE WHEN off > 0 THEN off ELSE 0e0 END)", 21), f"{_sum('(CASE WHEN off > 0 THEN off ELSE 0e0 END)', 21)} + {_sum('(CASE WHEN off < 0 THEN -off ELSE 0e0 END)', 21)}"),
    "MADisplaced_20_10": _ref("m20", 10), "TYP": "typical", "WMA_20": _weights("close", 20), "DC_upper_20": "h20", "DC_lower_20": "l20", "DC_middle_20": "(h20 + l20) / 2", "Qstick_20": _ma("(close - open)", 20),
    "FB_upper_1_618": f"m20 + 1.618e0 * {_ma('tr0', 20)}", "FB_lower_4_236": f"m20 - 4.236e0 * {_ma('tr0', 20)}", "ENV_upper_25_5pct": f"{_ma('close', 25)} * 1.05e0", "HLMA_high_20": _ma("high", 20), "HLMA_low_20": _ma("low", 20),
    "IMI_14": _by(_sum("(CASE WHEN close > open THEN close - open ELSE 0e0 END)", 14), f"{_sum('(CASE WHEN close > open THEN close - open ELSE 0e0 END)', 14)} + {_sum('(CASE WHEN open > close THEN open - close ELSE 0e0 END)', 14)}"),
    "OSC_40": "off", "OSCMA_20": _ma("off", 20), "CLV": "clv", "CLVMA_60": _ma("clv", 60), "BIASVOL_12": _by(f"volume - {_ma('volume', 12)}", _ma("volume", 12)),
}
_GAIN, _LOSS = _both("greatest", "moved1", "0e0"), _both("greatest", "-moved1", "0e0")
_VARY = _by("abs(close - c10)", _sum("abs(moved1)", 10))
_DMAX, _DMIN = _ma("(CASE WHEN high - h1 > 0 THEN high - h1 ELSE 0e0 END)", 20), _ma("(CASE WHEN l1 - low > 0 THEN l1 - low ELSE 0e0 END)", 20)
EXCEL |= {
    "POS_100": _by(f"p100 - {_llv('p100', 100)}", f"{_hhv('p100', 100)} - {_llv('p100', 100)}"), "TMA_20": _ma("m20", 20), "VMA_20": _ma("((high + low + open + close) / 4)", 20), "HMA_high_20": _ma("high", 20), "VIDYA_10": f"{_VARY} * close + (1 - {_VARY}) * c1",
    "FB_lower_1_618": "m20 - 1.618e0 * reach", "FB_upper_2_618": "m20 + 2.618e0 * reach", "FB_lower_2_618": "m20 - 2.618e0 * reach", "FB_upper_4_236": "m20 + 4.236e0 * reach", "BOP_20": _ma(_by("close - open", "high - low"), 20), "ENV_lower_25_5pct": "m25 * 0.95e0",
    "Demarker_20": _by(_DMAX, f"{_DMAX} + {_DMIN}"), "CMO_20": "100 * " + _by(f"{_sum(_GAIN, 20)} - {_sum(_LOSS, 20)}", f"{_sum(_GAIN, 20)} + {_sum(_LOSS, 20)}"), **{f"BIASVOL_{n}": _by(f"volume - {_ma('volume', n)}", _ma("volume", n)) for n in (6, 24)},
    "ROCVOL_80": _by(f"volume - {_ref('volume', 80)}", _ref("volume", 80)), "VWAP_20": _by(_sum("(volume * typical)", 20), _sum("volume", 20)), "MAAMT_40": _ma("(close * volume)", 40),
}
TV = {
    "williams_vix_fix_22": _by(f"{_hhv('close', 22)} - low", _hhv("close", 22)) + " * 100", "relative_volume_20": _by("volume", "v20"), "sma_50": _ma("close", 50), "wma_21": "w21", "vwma_20": _by(_sum("(close * volume)", 20), _sum("volume", 20)),
    "ichimoku_tenkan_9": f"({_hhv('high', 9)} + {_llv('low', 9)}) / 2", "ichimoku_span_b_raw": f"({_hhv('high', 52)} + {_llv('low', 52)}) / 2", "bb_20_upper": "m20 + 2 * s20", "bb_20_percent_b": _by("close - (m20 - 2 * s20)", "4 * s20"), "bb_20_width": _by("4 * s20", "m20"),
    "kc_20_upper": f"m20 + 1.5e0 * {_ma('tr0', 20)}", "donchian_20_mid": "(h20 + l20) / 2", "true_range_pct": _by("tr0", "close"), "stoch_k_14": "100 * " + _by("close - l14", "h14 - l14"), "williams_r_14": "-100 * " + _by("h14 - close", "h14 - l14"),
    "cci_20": _by("typical - t20", f"0.015e0 * {_deviation('typical', 't20', 20)}"), "mfi_14": _MFI, "roc_10": "100 * " + _by("close - c10", "c10"), "momentum_10": "close - c10", "awesome_oscillator": "ao", "accelerator_oscillator": f"ao - {_ma('ao', 5)}", "dpo_20": f"close - {_ref('m20', 11)}",
    "historical_volatility_20": f"{_f('stddev_pop', 'ret', 20)} * sqrt(252)", "linreg_20": f"CASE WHEN n >= 20 THEN regr_intercept(close, n) OVER ({_P} ROWS 19 PRECEDING) + n * regr_slope(close, n) OVER ({_P} ROWS 19 PRECEDING) END", "linreg_slope_50": f"CASE WHEN n >= 50 THEN regr_slope(close, n) OVER ({_P} ROWS 49 PRECEDING) END",
    "vortex_plus_14": _by(_sum("abs(high - l1)", 14), _sum("tr0", 14)), "cmf_20": _by(_sum("(clv * volume)", 20), _sum("volume", 20)), "eom_14": _ma(_by("moved * nullif(high - low, 0)", "volume"), 14), "rolling_vwap_20": _by(_sum("(typical * volume)", 20), _sum("volume", 20)), "dollar_volume_ma20": _ma("(close * volume)", 20),
    "volume_zscore_20": _by("volume - v20", _f("stddev_pop", "volume", 20)), "candle_body_pct": _by("abs(close - open)", "high - low"), "close_location_value": "clv", "gap_pct": _by("open - c1", "c1"), "inside_bar": "CASE WHEN high < h1 AND low > l1 THEN 1e0 ELSE 0e0 END", "breakout_high_20_prev": f"CASE WHEN close > {_ref('h20')} THEN 1e0 ELSE 0e0 END",
    "ultimate_oscillator": _uo("pressure0", "span0"), "uptick_volume_ratio_20": _by(_sum("(CASE WHEN close > c1 THEN volume ELSE 0e0 END)", 20), _sum("(CASE WHEN c1 IS NULL OR close <> c1 THEN volume ELSE 0e0 END)", 20)),
}
_HALF = lambda n: f"({_hhv('high', n)} + {_llv('low', n)})"  # noqa: E731  twice the middle of n rows
_KEPT = "m20 {sign} 1.5e0 * reach"
TV |= {
    "squeeze_momentum_lb": _line("squeezed", 20), "williams_vix_fix_upper_band": f"{_ma('wvf', 20)} + 2 * {_f('stddev_pop', 'wvf', 20)}",
    **{f"squeeze_{state}": f"CASE WHEN m20 - 2 * s20 {a} {_KEPT.format(sign='-')} AND m20 + 2 * s20 {b} {_KEPT.format(sign='+')} THEN 1e0 ELSE 0e0 END" for state, a, b in (("on", ">", "<"), ("off", "<", ">"))},
    "sma_10": "m10", "sma_100": _ma("close", 100), "close_to_sma_50": _by("close", "m50") + " - 1", "sma_20_50_gap": _by("m20", "m50") + " - 1", "hma_21": _weights("hull", 4), "alma_20": _alma("close", 20, 0.85, 6), "vwma_50": _by(_sum("(close * volume)", 50), _sum("volume", 50)),
    "linreg_slope_20": f"CASE WHEN n >= 20 THEN regr_slope(close, n) OVER ({_P} ROWS 19 PRECEDING) END", "linreg_50": _line("close", 50), "ichimoku_kijun_26": _HALF(26) + " / 2", "ichimoku_span_a_raw": f"({_HALF(9)} / 2 + {_HALF(26)} / 2) / 2", "bb_20_basis": "m20", "bb_20_lower": "m20 - 2 * s20",
    "bb_50_percent_b": _by("close - (m50 - 2 * s50)", "4 * s50"), "bb_50_width": _by("4 * s50", "m50"), "kc_20_lower": _KEPT.format(sign="-"), "kc_20_width": _by("3 * reach", "m20"), "donchian_20_upper": "h20", "donchian_20_lower": "l20",
    "donchian_55_upper": _hhv("high", 55), "donchian_55_lower": _llv("low", 55), "donchian_55_mid": _HALF(55) + " / 2", "historical_volatility_60": f"{_f('stddev_pop', 'ret', 60)} * sqrt(252)", "ulcer_index_14": f"sqrt({_ma('(fall * fall)', 14)})", "range_percentile_20": _rank("(high - low)", 20),
    "stoch_d_3": _ma("k14", 3), "roc_20": "100 * " + _by("close - c20", "c20"), "cmo_14": "100 * " + _by(f"{_sum(_GAIN, 14)} - {_sum(_LOSS, 14)}", f"{_sum(_GAIN, 14)} + {_sum(_LOSS, 14)}"), "vortex_minus_14": _by(_sum("abs(low - h1)", 14), _sum("tr0", 14)),
    "aroon_up_25": f"100 * {_place('high', 'max', 25)} / 25e0", "aroon_down_25": f"100 * {_place('low', 'min', 25)} / 25e0", "aroon_osc_25": f"100 * {_place('high', 'max', 25)} / 25e0 - 100 * {_place('low', 'min', 25)} / 25e0",
    "obv": _running("(coalesce(sign(moved1), 0) * volume)"), "adl": _running("(CASE WHEN c1 IS NULL THEN 0e0 ELSE coalesce(clv, 0e0) * volume END)"), "pvt": _running("coalesce(volume * ret, 0e0)"), "volume_osc_5_20": _by(f"{_ma('volume', 5)} - v20", "v20") + " * 100",
    "rolling_vwap_50": _by(_sum("(typical * volume)", 50), _sum("volume", 50)), "vwap_distance_20": _by("close", _by(_sum("(typical * volume)", 20), _sum("volume", 20))) + " - 1", "relative_volume_50": _by("volume", _ma("volume", 50)),
    "candle_upper_wick_pct": _by("high - greatest(open, close)", "high - low"), "candle_lower_wick_pct": _by("least(open, close) - low", "high - low"), "intrabar_return": _by("close", "open") + " - 1", "trend_bar_up": "CASE WHEN close > open AND close > c1 THEN 1e0 ELSE 0e0 END",
    "outside_bar": "CASE WHEN high > h1 AND low < l1 THEN 1e0 ELSE 0e0 END", "breakdown_low_20_prev": f"CASE WHEN close < {_ref('l20')} THEN 1e0 ELSE 0e0 END",
}
BY_HAND = {**{f"wh6_{k}": v for k, v in WH6.items()}, **{f"indicator_py_{k}": v for k, v in INDICATOR.items()}, **{f"excel_{k}": v for k, v in EXCEL.items()}, **{f"tv_{k}": v for k, v in TV.items()}}


def sql(bars: str, columns: list[str], wrap) -> str:
    outer = ", ".join(f"{wrap(c)} AS {c}" for c in columns)
    inner = ", ".join(f"{BY_HAND[c]} AS {c}" for c in columns)
    return f"WITH bars AS ({bars}), b AS ({B}), d AS ({D}), e AS ({E}), g AS ({G}), h AS ({H}) SELECT symbol, timeframe, trade_time, {outer} FROM (SELECT symbol, timeframe, trade_time, {inner} FROM h) q"
