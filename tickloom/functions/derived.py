"""Derived features over the unified hourly table (price, open interest, premium, spot flow).

Inputs are carried forward over missing hours first, so exponential means never see a gap inside a
series; they run over the whole series. Families return (layers, output columns).
"""

from __future__ import annotations

from tickloom.functions.dialect import Spark, at_least, avg, corr, div, full, lag, ln, over, span, std, zscore
from tickloom.plans.layers import Layer

FAST, SLOW, LONG = 24, 168, 720
Plan = tuple[list[Layer], list[str]]
INPUTS = [
    "open", "high", "low", "close", "volume", "sum_open_interest", "long_short_ratio", "premium_idx_close",
    "spot_close", "spot_volume", "spot_num_trades", "spot_taker_buy_volume",
]


def z(x: str, n: int) -> str:
    return zscore(x, n, int(n * 0.94))


def c4(a: str, b: str, n: int) -> str:
    return corr(a, b, n, max(1, n // 4))


def pct(x: str, k: int = 1) -> str:
    return f"({div(x, lag(x, k))} - 1)"


def emas(d: Spark, wanted: dict[str, tuple[str, int]]) -> list[Layer]:
    """Exponential means (unadjusted, by span) of columns: {name: (column, span)}."""
    return d.means({name: (c, span(n), None) for name, (c, n) in wanted.items()})


def base(d: Spark) -> list[Layer]:
    return [
        {f"x_{c}": d.last_known(c) for c in INPUTS},
        {
            "o": "x_open", "h": "x_high", "l": "x_low", "c": "x_close", "v": "x_volume", "oi": "x_sum_open_interest", "lsr": "x_long_short_ratio", "prem": "x_premium_idx_close", "sv": "x_spot_volume", "trades": "x_spot_num_trades",
            "imb": "2 * x_spot_taker_buy_volume - x_spot_volume", "ats": div("x_spot_volume * x_spot_close", "x_spot_num_trades"), "dom": div("x_spot_volume", "x_spot_volume + x_volume"), "n": "row_number() OVER (PARTITION BY symbol ORDER BY ts)",
        },
        {
            "r": ln(f"c / nullif({lag('c')}, 0)"), "pc": pct("c"), "hl": ln("h / nullif(l, 0)"), "co": ln("c / nullif(o, 0)"), "p4": "(o + h + l + c) / 4", "poi": pct("oi"), "psv": pct("sv"), "pdom": pct("dom"), "ptr": pct("trades"), "pats": pct("ats"),
            "pc24": pct("c", 24), "prev_c": lag("c"), "dollars": "c * v",
        },
        {f"park{n}": full(n, f"sqrt({avg('hl * hl', n)} / (4 * ln(2)))", "hl") for n in (24, 168, 720)} | {f"vwap{n}": full(n, div(over("sum", "p4 * v", n), over("sum", "v", n))) for n in (24, 168, 720)},
    ]


def time_primitive(d: Spark) -> Plan:
    parts = {"hr": "hour(ts)", "dw": d.weekday("ts"), "wm": "CAST(floor((day(ts) - 1) / 7) AS INT)", "mo": "month(ts) - 1"}
    names = (("hour_of_day", "hr", 24), ("day_of_week", "dw", 7), ("week_of_month", "wm + 1", 5), ("month_of_year", "mo + 1", 12))
    time = {f"{name}_{f}": f"{f}(2 * pi() * ({x}) / {n})" for name, x, n in names for f in ("sin", "cos")}
    out = time | {f"parkinson_volatility_{n}": f"park{n}" for n in (24, 168)} | {f"historical_volatility_{n}": full(n, f"{std('r', n)} * sqrt(365 * 24)", "r") for n in (24, 168)}
    return [*base(d), parts, out], list(out)


def rsi_adx(d: Spark) -> Plan:
    spans = (24, 168, 720)
    moves = {"up_m": f"coalesce(h - {lag('h')}, 0)", "dn_m": f"coalesce({lag('l')} - l, 0)", "gain": "coalesce(greatest(c - prev_c, 0), 0)", "loss": "coalesce(greatest(prev_c - c, 0), 0)", "tr": "greatest(h - l, abs(h - prev_c), abs(l - prev_c))"}
    dm = {"pdm": "CASE WHEN up_m > dn_m AND up_m > 0 THEN up_m ELSE 0 END", "mdm": "CASE WHEN dn_m > up_m AND dn_m > 0 THEN dn_m ELSE 0 END"}
    means = d.means({f"{x}{k}": (x, 1 / k, f"n >= {k}") for x in ("gain", "loss", "pdm", "mdm", "tr") for k in spans})
    di = {f"{s}di{k}": f"100 * {div(f'{s}dm{k}', f'tr{k}')}" for k in spans for s in ("p", "m")}
    dx = {f"dx{k}": f"100 * {div(f'abs(pdi{k} - mdi{k})', f'pdi{k} + mdi{k}')}" for k in spans}
    *dxs, adx = d.means({f"adx_{k}": (f"dx{k}", 1 / k, f"{d.seen(f'dx{k}')} >= {k}") for k in spans}, cast=False)
    out = {f"rsi_{k}": f"100 - 100 / (1 + {div(f'gain{k}', f'loss{k}')})" for k in spans} | adx
    return [*base(d), moves, dm, *means, di, dx, *dxs, out], list(out)


def zscores(d: Spark) -> Plan:
    means = emas(d, {"ema_c24": ("c", 24), **{f"ema_oi{n}": ("oi", n) for n in (24, 168, 720)}})
    dist = {f"vd{n}": div(f"c - vwap{n}", f"vwap{n}") for n in (24, 168, 720)} | {"ed24": div("c - ema_c24", "ema_c24")} | {f"od{n}": div(f"oi - ema_oi{n}", f"ema_oi{n}") for n in (24, 168, 720)}
    out = {
        **{f"price_vwap_distance_zscore_{n}_168": z(f"vd{n}", 168) for n in (24, 168, 720)}, **{f"price_ema_distance_zscore_24_{n}": z("ed24", n) for n in (168, 720)}, "taker_imb_zscore_168": z("imb", 168), "oi_zscore_168": z("oi", 168),
        **{f"oi_ema_distance_zscore_{n}_168": z(f"od{n}", 168) for n in (24, 168, 720)}, "premium_zscore_168": z("prem", 168), **{f"long_short_ratio_zscore_{n}": z("lsr", n) for n in (48, 168)}, "spot_vol_zscore_168": z("sv", 168),
        **{f"avg_trade_size_zscore_{n}": z("ats", n) for n in (48, 168)}, "spot_dominance_zscore_168": z("dom", 168),
    }
    return [*base(d), *means, dist, out], list(out)


def momentum(d: Spark) -> Plan:
    diffs = {"d24": f"ln(c) - {lag('ln(c)', 24)}", "lag_r": lag("r"), "cvd": over("sum", "imb", None)}
    out = {
        **{f"price_roc_over_volatility_24_{n}": div("pc24", f"park{n}") for n in (24, 168, 720)}, **{f"return_autocorr_{n}": corr("r", "lag_r", n) for n in (48, 168)},
        **{f"variance_ratio_24_{n}": full(n, div(over("var_samp", "d24", n), f"(24 * {over('var_samp', 'r', n)})"), "d24") for n in (48, 168, 720)}, **{f"taker_imb_cvd_slope_{n}": f"(cvd - {lag('cvd', n)}) / {n}" for n in (24, 168)},
        **{f"relative_volume_{n}": div("v", f"avg(v) OVER (PARTITION BY symbol, hour(ts) ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)") for n in (7, 14, 30)},
    }
    return [*base(d), diffs, out], list(out)


def acceleration(d: Spark) -> Plan:
    first = {f"acc_{x}": f"{p} - {lag(p)}" for x, p in (("c", "pc"), ("oi", "poi"))}
    second = {f"vol_{x}": f"sign({p}) * acc_{x}" for x, p in (("c", "pc"), ("oi", "poi"))}
    means = emas(d, {**{f"{k}_{x}{n}": (f"{k}_{x}", n) for k in ("acc", "vol") for x in ("c", "oi") for n in (24, 168)}, **{f"ema_{x}{n}": (x, n) for x in ("c", "oi") for n in (24, 168)}})
    out = {
        "oi_price_accel_product_168": f"{div('acc_oi168', 'vol_oi168')} * {div('acc_c168', 'vol_c168')}", "oi_price_momentum_168": f"{pct('ema_oi168')} * {pct('ema_c168')}", "oi_volatility_168": "vol_oi168", "oi_vol_ratio_24_168": div("vol_oi24", "vol_oi168"),
        **{f"scaled_acceleration_{n}": div(f"acc_c{n}", f"vol_c{n}") for n in (24, 168)}, "oi_price_ratio_spread_24_168": f"{div('ema_oi24', 'ema_oi168')} - {div('ema_c24', 'ema_c168')}",
    }
    return [*base(d), first, second, *means, out], list(out)


def mean_reversion(d: Spark) -> Plan:
    """Pullback slopes and crossing rates. A row without a sign yet counts as a crossing, as does the first row."""
    spans = (24, 168, 720)
    logs = {"lnc": ln("c")}
    means = emas(d, {f"eml{n}": ("lnc", n) for n in spans})
    dev = {f"dev_ema{n}": f"lnc - eml{n}" for n in spans} | {f"dev_vwap{n}": f"lnc - {ln(f'vwap{n}')}" for n in spans}
    sgn = {f"sg_ema{n}": f"nullif(sign(lnc - eml{n}), 0)" for n in spans} | {f"sg_vwap{n}": f"nullif(sign(c - vwap{n}), 0)" for n in spans}
    kinds = [f"{k}{n}" for k in ("ema", "vwap") for n in spans]
    pulled = {f"x_{k}": f"-({lag(f'dev_{k}')})" for k in kinds} | {f"fs_{k}": d.last_known(f"sg_{k}") for k in kinds}
    both = {f"xr_{k}": f"CASE WHEN r IS NOT NULL THEN x_{k} END" for k in kinds} | {f"cr_{k}": f"CASE WHEN fs_{k} IS NULL OR {lag(f'fs_{k}')} IS NULL OR fs_{k} <> {lag(f'fs_{k}')} THEN 1 ELSE 0 END" for k in kinds}
    name = lambda k: f"{k[:-len(k.lstrip('emavwp'))]}_{k.lstrip('emavwp')}"
    out = {f"pullback_slope_{name(k)}_{w}": full(w, div(over("covar_samp", f"xr_{k}, r", w), over("var_samp", f"xr_{k}", w)), f"xr_{k}") for k in kinds for w in (48, 168)}
    out |= {f"mean_cross_rate_{name(k)}_{w}": full(w, f"{over('sum', f'cr_{k}', w)} / {w - 1}e0") for k in kinds for w in (48, 168)}
    return [*base(d), logs, *means, dev | sgn, pulled, both, out], list(out)


def regime(d: Spark) -> Plan:
    var = {f"q5_{n}": full(n, d.quantile("r", 0.05, n), "r") for n in (168,)} | {"q95_168": full(168, d.quantile("r", 0.95, 168), "r"), "rets": d.gather("r", 168)}
    tail = {"tail": d.having("rets", "x", "x <= q5_168")}
    eff = {f"efficiency_avg_{n}": full(n, f"least(1.0, greatest(0.0, {over('sum', 'abs(co)', n)} / greatest({over('sum', 'abs(hl)', n)}, 1e-12)))", "co") for n in (24, 168)}
    sd = lambda x, n: at_least(x, n, max(1, n // 4), std(x, n))
    out = {
        "vol_ratio_24_168": div("park24", "park168"), "vol_ratio_24_720": div("park24", "park720"), "cvar_var_ratio_168": f"CASE WHEN q5_168 IS NOT NULL THEN {div(div(d.total('tail', 'x', 'x'), d.size('tail')), 'q5_168')} END",
        "tail_skewness_168": div("q95_168 + q5_168", "q95_168 - q5_168"), **{f"premium_vol_ratio_24_{n}": div(sd("prem", 24), f"({sd('prem', n)})") for n in (48, 168)}, "spot_dom_vol_ratio_24_168": div(sd("dom", 24), f"({sd('dom', 168)})"),
    }
    return [*base(d), var, tail, eff, out], [*eff, *out]


def tails_long(d: Spark) -> Plan:
    """The 720-hour tail ratios: they need 720 returns, hence 721 bars."""
    var = {"q5": full(720, d.quantile("r", 0.05, 720), "r"), "q95": full(720, d.quantile("r", 0.95, 720), "r"), "rets": d.gather("r", 720)}
    out = {"cvar_var_ratio_720": f"CASE WHEN q5 IS NOT NULL THEN {div(div(d.total('tail', 'x', 'x'), d.size('tail')), 'q5')} END", "tail_skewness_720": div("q95 + q5", "q95 - q5")}
    return [*base(d), var, {"tail": d.having("rets", "x", "x <= q5")}, out], list(out)


def interactions(d: Spark) -> Plan:
    eff = {f"eff{n}": full(n, f"least(1.0, greatest(0.0, {over('sum', 'abs(co)', n)} / greatest({over('sum', 'abs(hl)', n)}, 1e-12)))", "co") for n in (24, 168)} | {f"to_vwap{n}": ln(f"c / nullif(vwap{n}, 0)") for n in (168, 720)}
    eff |= {f"to_lag{k}": ln(f"c / nullif({lag('c', k)}, 0)") for k in (24, 48)}
    out = {f"displacement_speed_product_{n}_{k}": f"to_vwap{n} * to_lag{k}" for n in (168, 720) for k in (24, 48)} | {f"range_chop_interaction_{n}": f"park{n} * (1 - eff{n})" for n in (24, 168)}
    out |= {f"range_stretch_interaction_{n}_{k}": f"park{k} * abs(to_vwap{n})" for n in (168, 720) for k in (24, 168)}
    return [*base(d), eff, out], list(out)


def correlations(d: Spark) -> Plan:
    first = {"tr24": lag("trades", 24), "imb_z": z("imb", 168)}
    second = {"ptr24": pct("tr24")}
    out = {
        "trade_count_lead_price_corr_24_168": c4("ptr24", "pc", 168), "taker_imb_price_corr_168": c4("imb_z", "pc", 168), "avg_trade_size_price_corr_168": c4("pats", "pc", 168), "spot_vol_price_corr_168": c4("psv", "pc", 168), "oi_vol_price_corr_168": c4("poi", "pc", 168),
        **{f"spot_dom_price_corr_{n}": c4("pdom", "pc", n) for n in (24, 168)}, **{f"spot_dom_oi_corr_{n}": c4("pdom", "poi", n) for n in (24, 168)}, "trade_count_oi_corr_168": c4("ptr", "poi", 168), "trade_count_spot_dom_corr_168": c4("ptr", "pdom", 168),
    }
    return [*base(d), first, second, out], list(out)


def normalised(d: Spark, x: str, n: int, method: str = "median_ratio", logs: bool = True, eps: float = 1e-12) -> str:
    """Ratio to the rolling median or mean, or the difference or z-score to it; at 60 % of the window or more."""
    m = int(n * 0.6)
    if method in ("median_ratio", "mean_ratio"):
        level = d.quantile(x, 0.5, n) if method == "median_ratio" else avg(x, n)
        ratio = f"({x}) / ({level} + {eps!r})"
        return at_least(x, n, m, ln(f"({ratio} + {eps!r})") if logs else ratio)
    y = ln(f"({x} + {eps!r})") if logs else x
    if method == "demean":
        return at_least(x, n, m, f"{y} - {avg(y, n)}")
    if method == "zscore":
        return at_least(x, n, m, f"({y} - {avg(y, n)}) / ({std(y, n)} + {eps!r})")
    raise ValueError(f"unknown method: {method}")


def normalize_ratio(d: Spark) -> Plan:
    first = {"ami": "abs(r) / (nullif(dollars, 0) + 1e-12)", **{f"doi{n}": f"oi - {lag('oi', n)}" for n in (24, 48, 168)}, **{f"sumv{n}": full(n, over("sum", "v", n)) for n in (24, 48, 168)}}
    second = {"e24": div("abs(doi24)", "sumv24"), **{f"{s}{n}": div(f"greatest({g}doi{n}, 0)", f"sumv{n}") for n in (48, 168) for s, g in (("pos", ""), ("neg", "-"))}}
    second = {k: f"CASE WHEN {'doi' + k.lstrip('eposng')} IS NOT NULL THEN {e} END" for k, e in second.items()}
    out = {"relative_amihud_168": normalised(d, "ami", 168), "oi_volume_efficiency_24_168": normalised(d, "e24", 168), **{f"oi_volume_efficiency_signed_{s}_{n}_168": normalised(d, f"{s}{n}", 168) for n in (48, 168) for s in ("pos", "neg")}}
    return [*base(d), first, second, out], list(out)


def normalize_methods(d: Spark) -> Plan:
    """The other ways of setting a ratio against its window, on Amihud's illiquidity."""
    first = {"ami": "abs(r) / (nullif(dollars, 0) + 1e-12)", "amis": "abs(r) / (nullif(dollars, 0) + 1e-12) * 1e6"}
    out = {f"amihud_{m}_{'log' if logs else 'raw'}_168": normalised(d, "amis", 168, m, logs) for m in ("median_ratio", "mean_ratio", "demean", "zscore") for logs in (True, False)}
    return [*base(d), first, out], list(out)


def trend(d: Spark) -> Plan:
    """Least-squares slope of the close against the row number."""
    out = {f"linear_regression_slope_{n}": full(n, div(over("covar_pop", "c, n", n), over("var_pop", "n", n)), "c") for n in (24, 168)}
    return [*base(d), out], list(out)


def zero_fill(d: Spark) -> Plan:
    """Zeros become the last non-zero value before; missing stays missing."""
    columns = [c for c in INPUTS if not c.startswith("premium")]
    out = {f"{c}_filled": f"CASE WHEN {c} = 0 THEN {d.last_known(f'nullif({c}, 0)')} ELSE {c} END" for c in columns}
    return [out], list(out)


FAMILIES = (time_primitive, rsi_adx, zscores, momentum, acceleration, mean_reversion, regime, tails_long, interactions, correlations, normalize_ratio, normalize_methods, trend, zero_fill)
