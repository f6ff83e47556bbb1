"""Observation vectors for regime models: per timeframe log return, log-volume change and Parkinson volatility."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.dialect import Spark, avg, full, ln
from tickloom.operators import current_bar
from tickloom.plans import layers
from tickloom.sources.bars import as_of, right_closed

HOURS = {"1H": 1, "4H": 4, "12H": 12, "1D": 24}


@dataclass(frozen=True)
class Observations:
    timeframes: tuple[str, ...] = ("1H",)
    window: int = 20
    drop_warmup: bool = True

    def columns(self) -> list[str]:
        """Grouped by feature, then by timeframe."""
        return [f"{name}_{tf}" for name in ("close_logret_current", "log_volume_delta_current", f"close_parkinson_{self.window}") for tf in self.timeframes]


def plan(d: Spark, config: Observations = Observations(), tf: str | None = None) -> tuple[list[layers.Layer], list[str]]:
    """Columns of one timeframe, the first by default; the bars are that timeframe's."""
    made, _ = current_bar.layers(d)
    hl = {"hl_obs": ln("high / nullif(low, 0)")}
    tf = tf or config.timeframes[0]
    out = {f"close_logret_current_{tf}": "close_logret_current", f"log_volume_delta_current_{tf}": "log_volume_delta_current", f"close_parkinson_{config.window}_{tf}": full(config.window, f"sqrt({avg('hl_obs * hl_obs', config.window)} / (4 * ln(2)))")}
    return [*made, hl, out], list(out)


def observations(bars: DataFrame, config: Observations = Observations()) -> DataFrame:
    """(symbol, ts, ``config.columns()``) for hourly bars: at each hour every timeframe's last finished bar."""
    out = bars.select("symbol", "ts")
    for tf in config.timeframes:
        made, columns = plan(Spark(), config, tf)
        own = layers.apply(bars if HOURS[tf] == 1 else right_closed(bars, HOURS[tf]), made).select("symbol", "ts", *columns)
        out = own if len(config.timeframes) == 1 else out.join(as_of(bars.select("symbol", "ts"), own, columns), ["symbol", "ts"])
    out = out.select("symbol", "ts", *config.columns())
    return out.dropna(subset=config.columns()) if config.drop_warmup else out


def latest(bars: DataFrame, config: Observations) -> DataFrame:
    """The last whole vector of each symbol."""
    whole = observations(bars, config).dropna(subset=config.columns())
    return whole.groupBy("symbol").agg(F.max("ts").alias("ts"), *(F.max_by(c, "ts").alias(c) for c in config.columns()))


def merge(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", drop_missing: bool = False) -> DataFrame:
    """One-to-one merge of two feature tables; ``how`` is inner, left, right or outer. ValueError where a key is there twice."""
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown how: {how}")
    for name, side in (("left", left), ("right", right)):
        if side.groupBy(*keys).count().where("count > 1").limit(1).count():
            raise ValueError(f"keys of the {name} table are not unique")
    out = left.join(right, keys, how)
    return out.dropna(subset=[c for c in out.columns if c not in keys]) if drop_missing else out


#: The columns of the observation tables, from the indicator table and from the current-bar table; a timeframe is put behind each.
TABLES = {
    "v1": (["close_parkinson_20"], ["close_logret_current", "log_volume_delta_current"]),
    "v2": (["close_ret_zscore_20", "volume_rvol_20", "close_over_vwap", "close_log_ratio_vwap"], ["high_low_range_pct_current", "close_open_pct_current"]),
}


def table(features: DataFrame, current: DataFrame, version: str = "v2", timeframes: tuple[str, ...] = ("1H",), how: str = "inner", drop_missing: bool = False) -> DataFrame:
    """The observation table of a version: its columns of both tables, merged one to one by (symbol, ts), by feature, then by timeframe.

    Columns that a table lacks are warned of and left out. v1 puts the current-bar columns first, v2 the indicators.
    """
    wanted = [[f"{name}_{tf}" for name in names for tf in timeframes] for names in TABLES[version]]
    for df, names in zip((features, current), wanted):
        absent = [c for c in names if c not in df.columns]
        if absent:
            warnings.warn(f"no such columns: {absent}", stacklevel=2)
    left, right = (df.select("symbol", "ts", *(c for c in names if c in df.columns)) for df, names in zip((features, current), wanted))
    out = merge(left, right, ["symbol", "ts"], how, drop_missing)
    ordered = wanted[0] + wanted[1] if version == "v2" else wanted[1] + wanted[0]
    return out.select("symbol", "ts", *(c for c in ordered if c in out.columns))


def scaled(obs: DataFrame, columns: list[str], fitted: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation, by the means and deviations of ``fitted`` (or of
    ``obs``): one row, so broadcasting it is safe. A constant column is only centred."""
    base = obs if fitted is None else fitted
    stats = base.agg(*(F.avg(c).alias(f"__m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"__s_{c}") for c in columns))
    joined = obs.crossJoin(F.broadcast(stats))
    return joined.select("symbol", "ts", *(((F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 0, F.col(f"__s_{c}")).otherwise(1.0)).alias(c) for c in columns))
