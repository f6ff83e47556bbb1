"""Forward-looking targets: returns, excursions, triple barriers.

A target at a bar needs all of the next H bars. A bar on which both barriers are touched counts as -1
(``conservative``), or as the barrier nearer to that bar's open (``proximity``; ties are -1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.dialect import Spark, frame, lead
from tickloom.operators import store
from tickloom.plans import layers
from tickloom.plans.layers import Layer


@dataclass(frozen=True)
class Targets:
    horizons: tuple[int, ...] = (3, 6, 12, 24)
    barriers: tuple[tuple[float, float], ...] = ((0.02, 0.01),)
    ties: str = "conservative"
    entry: str = "close_t"
    logs: bool = True
    label: str = "b"

    def tag(self, h: int) -> str:
        return f"{h}{self.label}"


def _entry(t: Targets) -> Layer:
    return {"entry": "close" if t.entry == "close_t" else lead("open")}


def _known(h: int, e: str) -> str:
    return f"CASE WHEN count(*) {frame(h, True)} = {h} AND entry > 0 THEN {e} END"


def returns(d: Spark, t: Targets = Targets()) -> tuple[list[Layer], list[str]]:
    out = {}
    for h in sorted(set(t.horizons)):
        end = lead("close", h)
        out[f"y_{'logret' if t.logs else 'ret'}_{t.tag(h)}"] = _known(h, f"CASE WHEN {end} > 0 THEN {f'ln({end} / entry)' if t.logs else f'{end} / entry - 1'} END")
    return [_entry(t), out], list(out)


def excursions(d: Spark, t: Targets = Targets()) -> tuple[list[Layer], list[str]]:
    out = {}
    for h in sorted(set(t.horizons)):
        out[f"y_mfe_{t.tag(h)}"] = _known(h, f"(max(high) {frame(h, True)}) / entry - 1")
        out[f"y_mae_{t.tag(h)}"] = _known(h, f"(min(low) {frame(h, True)}) / entry - 1")
    return [_entry(t), out], list(out)


def barriers(d: Spark, t: Targets = Targets()) -> tuple[list[Layer], list[str]]:
    """The first touching bar, found in the array of the next H bars; both targets for each pair and horizon."""
    ahead = {f"next{h}": _known(h, d.gather_ahead(d.record(o="open", h="high", l="low"), h)) for h in t.horizons}
    hits, out = {}, {}
    for h in sorted(set(t.horizons)):
        for up, dn in t.barriers:
            name = f"u{up:g}_d{dn:g}_{t.tag(h)}"
            key = f"hit_{h}_{str(up).replace('.', '_')}_{str(dn).replace('.', '_')}"
            hits[key] = d.first(d.having(f"next{h}", "x", f"x.h >= entry * {1 + up!r} OR x.l <= entry * {1 - dn!r}"))
            top, bottom = f"{key}.h >= entry * {1 + up!r}", f"{key}.l <= entry * {1 - dn!r}"
            tie = "-1" if t.ties == "conservative" else f"CASE WHEN abs(entry * {1 + up!r} - {key}.o) < abs({key}.o - entry * {1 - dn!r}) THEN 1 ELSE -1 END"
            label = f"CASE WHEN next{h} IS NULL THEN NULL WHEN {key} IS NULL THEN 0 WHEN {top} AND {bottom} THEN {tie} WHEN {top} THEN 1 ELSE -1 END"
            out[f"`y_tb_label_{name}`"], out[f"`y_tp_before_sl_{name}`"] = label, f"CASE WHEN ({label}) IS NULL THEN NULL WHEN ({label}) = 1 THEN 1 ELSE 0 END"
    plain = {k.strip("`"): v for k, v in out.items()}
    return [_entry(t), ahead, hits, plain], list(plain)


def label_of(freq: str | None) -> str:
    """The unit of horizon labels for bars of a frequency: h, min, d, or b (bars) where it is unknown."""
    f = (freq or "").upper()
    if f.endswith("H"):
        return "h"
    if f.endswith("T") or f in ("MIN", "MINUTE"):
        return "min"
    return "d" if f.endswith("D") else "b"


def parse_pairs(pairs: list[str]) -> tuple[tuple[float, float], ...]:
    """``tp:sl`` texts to barrier pairs; ValueError where one is no pair of positive numbers."""
    out = []
    for text in pairs:
        up, colon, dn = text.partition(":")
        if not colon:
            raise ValueError(f"not a pair tp:sl: {text!r}")
        out.append((float(up), float(dn)))
        if not min(out[-1]) > 0:
            raise ValueError(f"barriers must be positive: {text!r}")
    return tuple(out)


@dataclass(frozen=True)
class Single:
    """One stored target: whether the upper barrier is touched before the lower one within the horizon."""

    dataset: str
    horizon: int = 24
    up: float = 0.04
    down: float = 0.02
    freq: str = "1H"
    ties: str = "conservative"

    @property
    def key(self) -> str:
        return f"y_tp_before_sl_u{self.up:g}_d{self.down:g}_{self.horizon}{label_of(self.freq)}"


def single(bars: DataFrame, t: Single) -> DataFrame:
    """(ts, dataset, target_key, target_value) for all bars of one symbol that have their whole horizon."""
    made, _ = barriers(Spark(), Targets(horizons=(t.horizon,), barriers=((t.up, t.down),), ties=t.ties, label=label_of(t.freq)))
    return store.to_targets(layers.apply(bars, made), t.dataset, [t.key])


def backfill_rows(bars: DataFrame, stored: DataFrame, t: Single, mode: str = "window", start: str | None = None, end: str | None = None, wanted: list[str] | None = None, at_most: int | None = None, force: bool = False) -> DataFrame:
    """The rows that a backfill would write.

    ``window`` takes bars in [start, end], both needed; ``last_from_targets`` those an hour after the last stored time of
    this target up to the last bar that has its horizon (ValueError if none is stored); ``ts_list`` the wanted times that are bars.
    Times stored already are skipped unless ``force``; ``at_most`` keeps the first times of the mode, stored or not.
    """
    own = stored.where((F.col("dataset") == t.dataset) & (F.col("target_key") == t.key))
    ts = F.col("ts")
    if mode == "window":
        if not (start and end):
            raise ValueError("a window needs start and end")
        times = bars.where((ts >= F.lit(start).cast("timestamp_ntz")) & (ts <= F.lit(end).cast("timestamp_ntz"))).select("ts")
    elif mode == "last_from_targets":
        last = own.agg(F.max("ts")).first()[0]
        if last is None:
            raise ValueError(f"no stored targets of {t.dataset} {t.key}: begin with a window")
        most = bars.agg((F.max("ts") - F.expr(f"interval {t.horizon} hours")).alias("__most"))
        times = bars.crossJoin(F.broadcast(most)).where((ts >= F.lit(last).cast("timestamp_ntz") + F.expr("interval 1 hour")) & (ts <= F.col("__most"))).select("ts")
    elif mode == "ts_list":
        if not wanted:
            raise ValueError("a list needs times")
        asked = bars.sparkSession.createDataFrame([(x.strip(),) for x in wanted], "t string").select(F.expr("try_cast(t as timestamp_ntz)").alias("ts"))
        times = bars.select("ts").join(asked.dropna().distinct(), "ts", "left_semi")
    else:
        raise ValueError(f"unknown mode: {mode}")
    times = times.distinct()
    if at_most is not None:
        times = times.orderBy("ts").limit(at_most)
    made = single(bars, t).join(times, "ts", "left_semi")
    out = made if force else store.missing(made, own, ["ts"])
    return out.select("ts", "dataset", "target_key", "target_value")


def backfill(spark: SparkSession, path: str, bars: DataFrame, t: Single, dry_run: bool = False, **mode) -> int:
    """Writes a backfill's rows to the store at ``path`` with created_at and returns their number; a dry run only counts."""
    stored = store.days(spark, path)
    if stored is None:
        stored = spark.createDataFrame([], "ts timestamp_ntz, dataset string, target_key string, target_value double")
    rows = backfill_rows(bars, stored, t, **mode)
    if dry_run:
        return rows.count()
    return store.upsert_days(spark, path, rows.withColumn("created_at", F.current_timestamp()), ["ts", "dataset", "target_key"])
