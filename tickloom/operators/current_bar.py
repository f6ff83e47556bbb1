"""Current-bar features of a timeframe, their lags, and the rules for lag names."""

from __future__ import annotations

from tickloom.functions.dialect import Spark, lag, ln
from tickloom.plans.layers import Layer

SINGLE = ["close_logret_current", "high_low_range_pct_current", "close_open_pct_current", "log_volume", "log_volume_delta_current", "sign_close_logret_current"]
PAIRS = [("close_logret_current", "log_volume_delta_current"), ("close_logret_current", "high_low_range_pct_current"), ("close_open_pct_current", "high_low_range_pct_current"), ("sign_close_logret_current", "log_volume_delta_current"), ("close_open_pct_current", "log_volume")]


def layers(d: Spark) -> tuple[list[Layer], list[str]]:
    first = {"prev_c": lag("close"), "log_volume": "CASE WHEN volume > -1 THEN ln(1 + volume) END"}
    second = {
        "close_logret_current": ln("close / nullif(prev_c, 0)"), "high_low_range_pct_current": "(high - low) / nullif(prev_c, 0)",
        "close_open_pct_current": "(close - open) / nullif(open, 0)", "log_volume_delta_current": f"log_volume - {lag('log_volume')}",
    }
    third = {"sign_close_logret_current": "sign(close_logret_current)"}
    fourth = {f"{a}_x_{b}": f"{a} * {b}" for a, b in PAIRS}
    return [first, second, third, fourth], [*SINGLE, *fourth]


def lag_name(name: str, k: int) -> str:
    """``_current`` becomes ``_lag_k``, on both sides of ``_x_``; other names get ``_lag_k`` at their end."""
    if k == 0:
        return name
    if "_x_" in name:
        return "_x_".join(lag_name(x, k) for x in name.split("_x_"))
    if name.endswith("_current"):
        return f"{name[: -len('_current')]}_lag_{k}"
    if "_current_" in name:
        return name.replace("_current_", f"_lag_{k}_")
    return f"{name}_lag_{k}"


def with_lags(d: Spark, most: int, names: list[str] | None = None) -> tuple[list[Layer], list[str]]:
    made, columns = layers(d)
    names = names or columns
    lags = {lag_name(c, k): lag(c, k) for k in range(1, most + 1) for c in names}
    return [*made, lags], [*names, *lags]
