"""Indicator families over bars (symbol, ts, open, high, low, close, volume).

Every function takes a dialect and returns (layers, output columns). ``LOOKBACK`` bounds what
path-dependent indicators see. Needs that a window has no full history give NULL.
"""

from __future__ import annotations

import math

from tickloom.functions.dialect import Spark, at_least, avg, corr, div, ewm, frame, full, kept_weight, lag, ln, over, root, span, std, zscore
from tickloom.plans.layers import Layer

LOOKBACK = 720
Plan = tuple[list[Layer], list[str]]

BASE: list[Layer] = [
    {
        "prev": lag("close"), "prev_open": lag("open"), "tp": "(high + low + close) / 3", "rn": "row_number() OVER (PARTITION BY symbol ORDER BY ts)",
        "hl": ln("high / nullif(low, 0)"), "co": ln("close / nullif(open, 0)"), "dollars": "close * volume", "prev_high": lag("high"), "prev_low": lag("low"),
        "prev_volume": lag("volume"),
    },
    {
        "r": ln("close / nullif(prev, 0)"), "d": "close - prev", "pct": f"{div('close', 'prev')} - 1", "prev_tp": lag("tp"),
        "tr": "greatest(high - low, abs(high - prev), abs(low - prev))", "clv": div("(close - low) - (high - close)", "high - low"),
    },
]


def returns_basic(d: Spark) -> Plan:
    out = {
        "close_open_diff_current": "close - open", "high_low_range_current": "high - low", "close_change_current": "d", "log_close": ln("close"), "close_pct_change_current": "pct * 100",
        **{f"close_cum_return_{n}": full(n, over("sum", "r", n), "r") for n in (5, 10, 20)},
        "close_zscore_20": zscore("close", 20), **{f"close_lag_{k}": lag("close", k) for k in (1, 2, 6)}, "volume_change": "volume - prev_volume",
        "volume_pct_change_current": f"100 * ({div('volume', 'prev_volume')} - 1)", "close_roc_10": f"100 * ({div('close', lag('close', 10))} - 1)", "volume_roc_10": f"100 * ({div('volume', lag('volume', 10))} - 1)",
        "close_ret_zscore_20": zscore("r", 20),
    }
    return [*BASE, out], list(out)


def moving_averages(d: Spark) -> Plan:
    sma = {f"close_sma_{n}": full(n, avg("close", n)) for n in (5, 20)} | {"volume_sma_20": full(20, avg("volume", 20)), "closes20": d.gather("close", 20)}
    out = {
        "close_wma_20": f"CASE WHEN {d.size('closes20')} >= 20 THEN {d.total_at('closes20', 'v * (i + 1)')} / 210e0 END",
        "close_ma_cross_diff_5_20": "close_sma_5 - close_sma_20", "close_ma_cross_ratio_5_20": div("close_sma_5", "close_sma_20"), "close_ma_cross_signal_5_20": "CASE WHEN close_sma_5 > close_sma_20 THEN 1 ELSE 0 END",
        "close_ma_distance_sma20": "close - close_sma_20", "close_ma_distance_pct_sma20": f"100 * {div('close - close_sma_20', 'close_sma_20')}", "volume_rvol_20": full(20, div("volume", avg("volume", 20))),
    }
    return [*BASE, sma, out], ["close_sma_5", "close_sma_20", "volume_sma_20", *out]


def macd_layers(d: Spark) -> list[Layer]:
    return [
        {"closes": d.gather("close", LOOKBACK)},
        {f"ema{n}": ewm(d, "closes", span(n), True) for n in (12, 26)},
        {"line": "ema12 - ema26"},
        {"lines": d.gather("line", LOOKBACK), "atr": full(15, avg("tr", 14))},
        {"signal": ewm(d, "lines", span(9), True)},
    ]


def ema_macd(d: Spark) -> Plan:
    ready = lambda e: f"CASE WHEN rn >= 26 THEN {e} END"
    out = {
        "close_ema_12": "CASE WHEN rn >= 12 THEN ema12 END", "close_macd_line_12_26": ready("line"), "close_macd_signal_9": ready("signal"), "close_macd_histogram_12_26_9": ready("line - signal"),
        "close_over_ema_12": f"CASE WHEN rn >= 12 THEN {div('close', 'ema12')} END", "close_log_ratio_ema_12": f"CASE WHEN rn >= 12 THEN {ln('close / nullif(ema12, 0)')} END",
        "close_dist_ema12_atr": f"CASE WHEN atr > 0 THEN {div('close - ema12', 'atr')} END",
        "close_macd_line_12_26_over_close": ready(div("line", "close")), "close_macd_histogram_12_26_9_over_close": ready(div("line - signal", "close")),
        "close_macd_line_12_26_over_atr14": ready(f"CASE WHEN atr > 0 THEN {div('line', 'atr')} END"), "close_macd_histogram_12_26_9_over_atr14": ready(f"CASE WHEN atr > 0 THEN {div('line - signal', 'atr')} END"),
    }
    return [*BASE, *macd_layers(d), out], list(out)


def rsi_adx(d: Spark) -> Plan:
    """Wilder means are seeded with zero moves at the first row."""
    a = 1 / 14
    moves = {
        "gain": "coalesce(greatest(d, 0), 0)", "loss": "coalesce(greatest(-d, 0), 0)", "up": "coalesce(high - prev_high, 0)", "down": "coalesce(prev_low - low, 0)",
    }
    kept = {"plus": "CASE WHEN up > down AND up > 0 THEN up ELSE 0 END", "minus": "CASE WHEN down > up AND down > 0 THEN down ELSE 0 END"}
    arrays = {x: d.gather(f"CAST({y} AS DOUBLE)", LOOKBACK) for x, y in (("gains", "gain"), ("losses", "loss"), ("pluses", "plus"), ("minuses", "minus"), ("trs", "tr"))}
    means = {"g": ewm(d, "gains", a, False), "l": ewm(d, "losses", a, False), "p": ewm(d, "pluses", a, False), "m": ewm(d, "minuses", a, False), "t": ewm(d, "trs", a, False)}
    di = {"dip": f"CASE WHEN rn >= 14 THEN 100 * {div('p', 't')} END", "dim": f"CASE WHEN rn >= 14 THEN 100 * {div('m', 't')} END"}
    dx = {"dx": f"100 * {div('abs(dip - dim)', 'dip + dim')}"}
    # A missing DX decays what stands before it: the weight kept grows smaller with the rows since the last one.
    since = "rn - max(CASE WHEN dx IS NOT NULL THEN rn END) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    gap = {"dx_keep": kept_weight(since, a)}
    out = {
        "close_rsi_14": f"CASE WHEN rn >= 15 THEN CASE WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + {div('g', 'l')}) END END",
        "close_adx_14": f"CASE WHEN count(dx) {frame(LOOKBACK)} >= 14 THEN {d.folded('dxs')} END", "close_di_plus_14": "dip", "close_di_minus_14": "dim",
    }
    return [*BASE, moves, kept, arrays, means, di, dx, gap, {"dxs": d.gather(d.pair_where("dx", "CAST(dx AS DOUBLE)", "dx_keep"), LOOKBACK)}, out], list(out)


def oscillators(d: Spark) -> Plan:
    lo, hi = over("min", "low", 14), over("max", "high", 14)
    one = {
        "k": full(14, f"CASE WHEN {hi} = {lo} THEN 50e0 ELSE 100 * {div(f'close - {lo}', f'{hi} - {lo}')} END"),
        "bp": "CASE WHEN prev IS NOT NULL THEN close - least(low, prev) END", "utr": "CASE WHEN prev IS NOT NULL THEN greatest(high, prev) - least(low, prev) END",
        "tps": d.gather("tp", 20), "mean_tp": avg("tp", 20), "pos_flow": "CASE WHEN tp > prev_tp THEN tp * volume ELSE 0 END", "neg_flow": "CASE WHEN tp < prev_tp THEN tp * volume ELSE 0 END",
        "range_lo": lo, "range_hi": hi,
    }
    two = {"mad": d.total("tps", "x", "abs(x - mean_tp)") + " / 20", **{f"u{n}": full(n, div(over("sum", "bp", n), over("sum", "utr", n)), "bp") for n in (7, 14, 28)}, "pos14": over("sum", "pos_flow", 14), "neg14": over("sum", "neg_flow", 14)}
    out = {
        "close_stoch_k_14": "k", "close_stoch_d_14_3": full(3, avg("k", 3), "k"), "close_williams_r_14": full(14, f"CASE WHEN range_hi = range_lo THEN -50e0 ELSE -100 * {div('range_hi - close', 'range_hi - range_lo')} END"),
        "close_cci_20": full(20, div("tp - mean_tp", "0.015 * mad")), "close_uo_7_14_28": "100 * (4 * u7 + 2 * u14 + u28) / 7", "close_mfi_14": f"CASE WHEN rn >= 15 THEN CASE WHEN neg14 = 0 THEN 100.0 ELSE 100 - 100 / (1 + {div('pos14', 'neg14')}) END END",
    }
    flags = {f"{x}_{kind}": f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} {op} {v} THEN 1 ELSE 0 END" for x, low, high in (("close_stoch_k_14", 20, 80), ("close_mfi_14", 20, 80)) for kind, op, v in (("oversold", "<", low), ("overbought", ">", high))}
    cross = {"close_stoch_k_14_x_close_mfi_14": "close_stoch_k_14 * close_mfi_14"}
    return [*BASE, one, two, out, flags | cross], [*out, *flags, *cross]


def volatility_range(d: Spark) -> Plan:
    one = {
        "atr": full(15, avg("tr", 14)), "sd20": std("close", 20), "mid": full(20, avg("close", 20)), "gk": avg("0.5 * hl * hl - (2 * ln(2) - 1) * co * co", 20),
        "rs_row": f"{ln('high / nullif(close, 0)')} * {ln('high / nullif(open, 0)')} + {ln('low / nullif(close, 0)')} * {ln('low / nullif(open, 0)')}", "gap": ln("open / nullif(prev, 0)"),
    }
    two = {"rs": avg("rs_row", 20), "yz_k": f"0.34 / (1.34 + {21 / 19!r})", "var_o": over("var_samp", "gap", 20), "var_c": over("var_samp", "co", 20)}
    out = {
        "close_hv_20": full(20, f"{std('r', 20)} * sqrt(365)", "r"), "close_atr_14": "atr", "close_bb_upper_20_2": "mid + 2 * sd20", "close_bb_middle_20": "mid", "close_bb_lower_20_2": "mid - 2 * sd20", "close_bb_width_20_2": "CASE WHEN mid IS NOT NULL THEN 4 * sd20 END",
        "close_bb_percent_20_2": f"CASE WHEN mid IS NOT NULL THEN CASE WHEN sd20 = 0 THEN 0.5 ELSE {div('close - mid + 2 * sd20', '4 * sd20')} END END", "close_bb_width_pct_20_2": div("CASE WHEN mid IS NOT NULL THEN 4 * sd20 END", "mid"),
        "close_vol_ratio_5_50": full(50, div(std("r", 5), std("r", 50)), "r"), "close_parkinson_20": full(20, f"sqrt({avg('hl * hl', 20)} / (4 * ln(2)))"), "close_gk_20": full(20, root("gk")), "close_rs_20": full(20, root("rs")),
        "close_yz_20": full(20, root("var_o + yz_k * var_c + (1 - yz_k) * rs"), "gap"), "close_vol_adj_return_atr14": f"CASE WHEN atr > 0 THEN {div('r', 'sqrt(atr)')} END", "close_dist_sma20_atr": f"CASE WHEN atr > 0 THEN {div('close - mid', 'atr')} END",
    }
    return [*BASE, one, two, out], list(out)


def volume_flow(d: Spark) -> Plan:
    one = {"adl_row": "coalesce(clv * volume, 0)", "obv_row": "CASE WHEN rn > 1 THEN sign(d) * volume ELSE 0 END"}
    two = {"adl": over("sum", "adl_row", LOOKBACK), "obv": over("sum", "obv_row", LOOKBACK - 1), "adl_all": over("sum", "adl_row", None), "vwap": div(over("sum", "tp * volume", LOOKBACK), over("sum", "volume", LOOKBACK)), "dv20": full(20, over("sum", "dollars", 20))}
    out = {
        "close_obv": "obv", "close_vwap": "vwap", "close_adl": "adl", "close_chaikin_3_10": f"CASE WHEN rn >= 10 THEN {ewm(d, 'adls', span(3), True)} - {ewm(d, 'adls', span(10), True)} END",
        "close_volume_ratio": div("close", "volume"), "high_volume_ratio": div("high", "volume"), "close_obv_over_dollar_vol_20": div("obv", "dv20"), "close_adl_over_dollar_vol_20": div("adl", "dv20"),
        "close_over_vwap": div("close", "vwap"), "close_log_ratio_vwap": ln("close / nullif(vwap, 0)"),
    }
    # Chaikin smooths sums from any one start: a constant shift cancels in the difference.
    return [*BASE, one, two, {"adls": d.gather("CAST(adl_all AS DOUBLE)", LOOKBACK)}, out], list(out)


def distribution_stats(d: Spark) -> Plan:
    """Population skewness and excess kurtosis, by central moments."""
    one = {"pcts": d.gather("pct", 30), "m1": avg("pct", 30), "lag_pct": lag("pct"), "c20": d.gather("close", 20), "lo20": over("min", "close", 20), "hi20": over("max", "close", 20)}
    two = {f"m{k}": f"{d.total('pcts', 'x', f'power(x - m1, {k})')} / 30" for k in (2, 3, 4)}
    inside = "least(9, floor((x - lo20) / nullif(hi20 - lo20, 0) * 10))"
    bins = {f"bin{k}": f"{d.size(d.having('c20', 'x', f'{inside} = {k}'))} / 20e0" for k in range(10)}
    sum_bins = " + ".join(f"bin{k} * ln(bin{k} + 1e-10)" for k in range(10))
    out = {
        "close_skew_30": f"CASE WHEN {d.size('pcts')} >= 30 THEN {div('m3', 'power(m2, 1.5)')} END", "close_kurt_30": f"CASE WHEN {d.size('pcts')} >= 30 THEN {div('m4', 'm2 * m2')} - 3 END",
        "close_autocorr_1_30": corr("pct", "lag_pct", 30), "close_entropy_20": full(20, f"CASE WHEN hi20 > lo20 THEN -({sum_bins}) ELSE -ln(1 + 1e-10) END"), "close_hurst_100": "CASE WHEN rn >= 100 THEN 0.0 END",
        "close_volume_rolling_corr_20": corr("close", "volume", 20),
    }
    return [*BASE, one, two, bins, out], list(out)


def percentiles(d: Spark) -> Plan:
    out = {f"close_percentile_{p}_20": full(20, d.quantile("close", p / 100, 20)) for p in (25, 50, 75)}
    return [*BASE, out], list(out)


def candles_time(d: Spark) -> Plan:
    turn = lambda x, n: {f"time_{x}_sin": f"sin(2 * pi() * {n[0]} / {n[1]})", f"time_{x}_cos": f"cos(2 * pi() * {n[0]} / {n[1]})"}
    parts = {"time_hour_of_day": "hour(ts)", "time_day_of_week": d.weekday("ts"), "time_day_of_month": "day(ts)", "time_month_of_year": "month(ts)"}
    out = {
        "close_candle_body_ratio": div("abs(close - open)", "high - low"), "close_candle_upper_shadow_ratio": div("high - greatest(open, close)", "high - low"), "close_candle_lower_shadow_ratio": div("least(open, close) - low", "high - low"),
        "close_typical_price": "tp", "close_ohlc_average": "(open + high + low + close) / 4", **turn("hour", ("time_hour_of_day", 24)), **turn("dow", ("time_day_of_week", 7)), **turn("month", ("time_month_of_year", 12)),
    }
    return [*BASE, parts, out], [*parts, *out]


def extremes_channels(d: Spark) -> Plan:
    cmin, cmax, hi, lo = over("min", "close", 20), over("max", "close", 20), over("max", "high", 20), over("min", "low", 20)
    one = {"cmin": cmin, "cmax": cmax, "hi": hi, "lo": lo, "bars14": d.gather(d.record(h="high", l="low", n="rn"), 14), "hi14": over("max", "high", 14), "lo14": over("min", "low", 14)}
    two = {"hi_at": d.first(d.having("bars14", "x", "x.h = hi14")), "lo_at": d.first(d.having("bars14", "x", "x.l = lo14"))}
    up, down = "100 * (14 - (rn - hi_at.n)) / 14e0", "100 * (14 - (rn - lo_at.n)) / 14e0"
    out = {
        "close_rolling_min_20": full(20, "cmin"), "close_rolling_max_20": full(20, "cmax"), "close_position_in_range_20": full(20, f"CASE WHEN cmax = cmin THEN 0.5 ELSE {div('close - cmin', 'cmax - cmin')} END"),
        "close_donchian_pos_20": full(20, f"CASE WHEN hi = lo THEN 0.5 ELSE {div('close - lo', 'hi - lo')} END"), "close_donchian_upper_dist_20": full(20, f"CASE WHEN hi = lo THEN 0.0 ELSE {div('hi - close', 'hi - lo')} END"), "close_donchian_lower_dist_20": full(20, f"CASE WHEN hi = lo THEN 0.0 ELSE {div('close - lo', 'hi - lo')} END"),
        "close_aroon_up_14": full(14, up), "close_aroon_down_14": full(14, down), "close_aroon_osc_14": full(14, f"{up} - {down}"),
    }
    return [*BASE, one, two, out], list(out)


def liquidity(d: Spark) -> Plan:
    one = {"lag_d": lag("d"), "illiq": div("abs(r)", "dollars")}
    two = {"cov": over("covar_samp", "d, lag_d", 19)}
    out = {"close_roll_spread_20": full(19, "CASE WHEN cov < 0 THEN 2 * sqrt(-cov) END", "lag_d"), "close_amihud_20": full(20, avg("illiq", 20), "r"), "turnover_z_20": zscore("dollars", 20)}
    return [*BASE, one, two, out], list(out)


def var_cvar(d: Spark) -> Plan:
    one = {"rs50": d.gather("r", 50), "var5": full(50, d.quantile("r", 0.05, 50), "r")}
    tail = d.having("rs50", "x", "x <= var5")
    two = {"tail": tail}
    out = {"close_var_5_50": "var5", "close_cvar_5_50": f"CASE WHEN var5 IS NOT NULL THEN {div(d.total('tail', 'x', 'x'), d.size('tail'))} END"}
    return [*BASE, one, two, out], list(out)


def ou_halflife(d: Spark) -> Plan:
    one = {"beta": full(100, over("regr_slope", "d, prev", 100), "d")}
    out = {"close_ou_halflife_100": f"CASE WHEN beta < 0 THEN {-math.log(2)!r} / beta END"}
    return [*BASE, one, out], list(out)


def permutation_entropy(d: Spark) -> Plan:
    """Ordinal patterns of three neighbouring closes over 50 bars, over the log of the patterns seen."""
    one = {"p1": lag("close", 1), "p2": lag("close", 2)}
    two = {"pattern": "CASE WHEN p2 IS NOT NULL THEN CASE WHEN p2 <= p1 THEN 0 ELSE 1 END + 2 * CASE WHEN p2 <= close THEN 0 ELSE 1 END + 4 * CASE WHEN p1 <= close THEN 0 ELSE 1 END END"}
    three = {f"f{k}": f"count(CASE WHEN pattern = {k} THEN 1 END) {frame(48)} / 48e0" for k in range(8)}
    seen, mass = " + ".join(f"CASE WHEN f{k} > 0 THEN 1 ELSE 0 END" for k in range(8)), " + ".join(f"CASE WHEN f{k} > 0 THEN f{k} * ln(f{k}) ELSE 0 END" for k in range(8))
    out = {"close_perm_entropy_3_50": f"CASE WHEN count(pattern) {frame(48)} >= 48 AND ({seen}) > 1 THEN -({mass}) / ln({seen}) END"}
    return [*BASE, one, two, three, out], list(out)


def spectrum(d: Spark) -> Plan:
    """Discrete Fourier terms of the demeaned last 50 closes, as dot products with constant waves."""
    one = {"c50": d.gather("close", 50), "mean50": avg("close", 50)}
    two = {f"{w}{k}": d.total_at("c50", f"(v - mean50) * {f}(2 * pi() * {k} * i / 50)") for k in range(1, 26) for w, f in (("re", "cos"), ("im", "sin"))}
    three = {f"a{k}": f"sqrt(re{k} * re{k} + im{k} * im{k})" for k in range(1, 26)}
    names = [f"a{k}" for k in range(1, 25)]
    power = " + ".join(f"a{k} * a{k}" for k in range(1, 26))
    four = {"top": f"greatest({', '.join(names)})", "all_a": " + ".join(names), "all_p": power}
    cycle = "CASE " + " ".join(f"WHEN a{k} = top THEN {k}" for k in range(1, 25)) + " END"
    shares = " + ".join(f"CASE WHEN a{k} > 0 THEN a{k} * a{k} / all_p * ln(a{k} * a{k} / all_p) ELSE 0 END" for k in range(1, 26))
    out = {"close_dominant_cycle_length_50": full(50, f"50e0 / ({cycle})"), "close_cycle_strength_50": full(50, div("top", "all_a")), "close_spectral_entropy_50": full(50, f"CASE WHEN all_p > 0 THEN -({shares}) / ln(26) END")}
    return [*BASE, one, two, three, four, out], list(out)


def thresholds(values: dict[str, dict[str, float]]) -> Layer:
    """Flags {column}_oversold (under) and {column}_overbought (over) for columns with bounds; NULL where the column is."""
    return {f"{x}_{kind}": f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} {'<' if kind == 'oversold' else '>'} {v!r} THEN 1 ELSE 0 END" for x, bounds in values.items() for kind, v in bounds.items()}


def interactions(pairs: list[tuple[str, str]], present: list[str]) -> Layer:
    """Products {a}_x_{b}; NULL where a column is NULL or absent."""
    return {f"{a}_x_{b}": f"{a} * {b}" if a in present and b in present else "CAST(NULL AS DOUBLE)" for a, b in pairs}


def rolling_correlations(pairs: list[tuple[str, str]], n: int) -> Layer:
    return {f"{a}_{b}_rolling_corr_{n}": corr(a, b, n) for a, b in pairs}


def flags_terms(d: Spark) -> Plan:
    """Thresholds, interactions and rolling correlations over the oscillators, by configuration."""
    made, columns = oscillators(d)
    flags = thresholds({"close_uo_7_14_28": {"oversold": 35.0, "overbought": 65.0}, "close_cci_20": {"oversold": -100.0, "overbought": 100.0}, "close_williams_r_14": {"oversold": -80.0, "overbought": -20.0}})
    terms = interactions([("close_cci_20", "close_uo_7_14_28"), ("close_mfi_14", "close_williams_r_14"), ("close_mfi_14", "absent")], columns)
    together = rolling_correlations([("high", "volume"), ("close", "open")], 20)
    return [*made, flags | terms | together], [*flags, *terms, *together]


FAMILIES = (returns_basic, moving_averages, ema_macd, rsi_adx, oscillators, volatility_range, volume_flow, distribution_stats, percentiles, candles_time, extremes_channels, liquidity, var_cvar, ou_halflife, permutation_entropy, spectrum, flags_terms)
#: Families that fold long arrays; a bundle may leave them out.
SLOW = (permutation_entropy, spectrum, ou_halflife)
