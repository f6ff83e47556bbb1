"""Registered queries over the test tables, each with the oracle's SQL."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from tickloom.functions import derived, snapshot
from tickloom.functions.dialect import Duck, Spark, kept_weight, lag, span
from tickloom.operators import current_bar, hmm, lookback, store, targets
from tickloom.plans import layers
from tickloom.sources import bars

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
S, D = Spark(), Duck()


def hourly(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    return bars.hourly(bars.events(spark, sf_dir), by_type)


def places(plan: Callable) -> int:
    """Digits that are kept; ratios to volumes often tie at six."""
    return 8 if plan is snapshot.volume_flow else 6


def planned(name: str, plan: Callable, source: Callable[[SparkSession, str], DataFrame], source_sql: str, places: int = 6) -> None:
    """Registers a layered plan on both sides; values are rounded alike."""
    lines, columns = plan(D)
    QUERIES[name] = lambda spark, sf_dir: layers.finish(layers.apply(source(spark, sf_dir), plan(S)[0]), [f"`{c}`" for c in columns], places).toDF("symbol", "ts", *(c.replace(".", "_") for c in columns))
    named = ", ".join(f'round(CAST("{c}" AS DOUBLE), {places}) AS "{c.replace(".", "_")}"' for c in columns)
    ORACLE[name] = layers.to_sql(source_sql, lines) + f" SELECT symbol, ts, {named} FROM b{len(lines)}"


def simple(name: str, query: Query, sql: str) -> None:
    QUERIES[name], ORACLE[name] = query, sql


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if isinstance(df.schema[c].dataType, DoubleType) else F.col(c) for c in df.columns))


ALL, TYPES = bars.hourly_sql(), bars.hourly_sql(True)
OUT = "symbol, ts, " + ", ".join(f"round({c}, 6) AS {c}" for c in bars.COLUMNS)
simple("bars_1h", lambda s, d: rounded(hourly(s, d)), f"SELECT {OUT} FROM ({ALL})")
simple("bars_1h_by_type", lambda s, d: rounded(hourly(s, d, True)), f"SELECT {OUT} FROM ({TYPES})")
for _h, _n in ((4, "4h"), (12, "12h"), (24, "1d")):
    simple(f"bars_{_n}_right_closed", lambda s, d, h=_h: rounded(bars.right_closed(hourly(s, d, True), h)), f"SELECT {OUT} FROM ({bars.right_closed_sql(TYPES, _h)})")
simple("bars_empty_bins", lambda s, d: rounded(bars.right_closed(hourly(s, d, True), 1, True)), f"SELECT {OUT} FROM ({bars.right_closed_sql(TYPES, 1, True)})")

for _f in snapshot.FAMILIES:
    planned(_f.__name__, _f, lambda s, d: hourly(s, d), ALL, places(_f))
planned("rsi_adx_by_type", snapshot.rsi_adx, lambda s, d: hourly(s, d, True), TYPES)
planned("oscillators_4h", snapshot.oscillators, lambda s, d: bars.right_closed(hourly(s, d), 4), bars.right_closed_sql(ALL, 4))
for _f in derived.FAMILIES:
    planned(f"series_{_f.__name__}", _f, lambda s, d: bars.unified(hourly(s, d, True), hourly(s, d)), bars.unified_sql())
planned("current_bar_1h", current_bar.layers, lambda s, d: hourly(s, d), ALL)
planned("current_bar_lags_1h", lambda d: current_bar.with_lags(d, 3), lambda s, d: hourly(s, d), ALL)
for _t, _n in ((targets.Targets(), "conservative"), (targets.Targets(ties="proximity", entry="open_t1", logs=False, barriers=((0.5, 0.5), (5.0, 0.9))), "proximity")):
    planned(f"targets_returns_{_n}", lambda d, t=_t: targets.returns(d, t), lambda s, d: hourly(s, d), ALL)
    planned(f"targets_mfe_mae_{_n}", lambda d, t=_t: targets.excursions(d, t), lambda s, d: hourly(s, d), ALL)
    planned(f"targets_barrier_{_n}", lambda d, t=_t: targets.barriers(d, t), lambda s, d: hourly(s, d), ALL)



def clean(c: str) -> str:
    return c.replace(".", "_")


def bundle(df: DataFrame, plans: list[Callable]) -> DataFrame:
    """All columns of several families beside (symbol, ts): families follow each other over the same partitioning and order,
    and a family's helper columns go when it is done."""
    base, done = df.columns, []
    for plan in plans:
        made, columns = plan(S)
        df = layers.apply(df, made).select(*base, *done, *(F.round(F.col(f"`{c}`").cast("double"), places(plan)).alias(f"out:{clean(c)}") for c in columns))
        done += [f"`out:{clean(c)}`" for c in columns]
    return df.select("symbol", "ts", *(F.col(c).alias(c[5:-1]) for c in done))


def bundle_sql(source: str, plans: list[Callable]) -> tuple[str, list[str]]:
    """The same, each family by itself, joined by key."""
    parts, names = [], []
    for k, plan in enumerate(plans):
        made, columns = plan(D)
        parts.append(f"({layers.to_sql(source, made)} SELECT symbol, ts, " + ", ".join(f'round(CAST("{c}" AS DOUBLE), {places(plan)}) AS "{clean(c)}"' for c in columns) + f" FROM b{len(made)}) f{k}")
        names += map(clean, columns)
    return "SELECT * FROM " + parts[0] + "".join(f" JOIN {p} USING (symbol, ts)" for p in parts[1:]), names


def project(df: DataFrame, wanted: list[str] | None, missing: str = "skip") -> DataFrame:
    """Keys and the wanted features in their order; features that are not there are skipped, or warned of, or an error."""
    if wanted is None:
        return df
    absent = [c for c in wanted if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"no such features: {absent}")
    if absent and missing == "warn":
        warnings.warn(f"no such features: {absent}", stacklevel=2)
    return df.select("symbol", "ts", *(c for c in wanted if c in df.columns))


def features(base: DataFrame, timeframes: tuple[str, ...] = ("1H",), skip_slow: bool = True, wanted: list[str] | None = None, missing: str = "skip") -> DataFrame:
    """The indicator bundle of hourly bars for each timeframe, columns with the timeframe's suffix, as of each hour."""
    plans = [f for f in snapshot.FAMILIES if not (skip_slow and f in snapshot.SLOW)]
    out = None
    for tf in timeframes:
        # Families that make nothing wanted are not planned at all.
        needed = [p for p in plans if wanted is None or any(f"{clean(c)}_{tf}" in wanted for c in p(S)[1])]
        if not needed:
            continue
        own = bundle(base if hmm.HOURS[tf] == 1 else bars.right_closed(base, hmm.HOURS[tf]), needed)
        named = own.toDF("symbol", "ts", *(f"{c}_{tf}" for c in own.columns[2:]))
        if hmm.HOURS[tf] > 1:
            named = bars.as_of(base.select("symbol", "ts"), named, named.columns[2:])
        out = named if out is None else out.join(named, ["symbol", "ts"])
    return project(base.select("symbol", "ts") if out is None else out, wanted, missing)


_FAST = [f for f in snapshot.FAMILIES if f not in snapshot.SLOW]


def _bundle_sql(tf: str) -> str:
    hours = hmm.HOURS[tf]
    made, names = bundle_sql(ALL if hours == 1 else bars.right_closed_sql(ALL, hours), _FAST)
    columns = ", ".join(f'f."{c}" AS "{c}_{tf}"' for c in names)
    return f"SELECT h.symbol AS symbol, h.ts AS ts, {columns} FROM ({ALL}) h ASOF LEFT JOIN ({made}) f ON h.symbol = f.symbol AND h.ts >= f.ts"


simple("bundle_1h", lambda s, d: features(hourly(s, d)), _bundle_sql("1H"))
simple("bundle_4h", lambda s, d: features(hourly(s, d), ("4H",)), _bundle_sql("4H"))
_SERIES = [f for f in derived.FAMILIES if f not in (derived.zero_fill, derived.normalize_methods, derived.trend)]
_SERIES_SQL, _ = bundle_sql(bars.unified_sql(), _SERIES)
simple("series_bundle", lambda s, d: bundle(bars.unified(hourly(s, d, True), hourly(s, d)), _SERIES), _SERIES_SQL)

_LAG_LINES, _LAG_COLUMNS = current_bar.with_lags(D, 2)


def current_bar_lags_4h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and lags of 4-hour bars, as of each hour: they change when a 4-hour bar closes."""
    base = hourly(spark, sf_dir)
    made, columns = current_bar.with_lags(S, 2)
    slow = layers.apply(bars.right_closed(base, 4), made)
    return rounded(bars.as_of(base, slow, columns).toDF("symbol", "ts", *(f"{c}_4H" for c in columns)))


simple("current_bar_lags_4h", current_bar_lags_4h, layers.to_sql(bars.right_closed_sql(ALL, 4), _LAG_LINES) + " SELECT h.symbol AS symbol, h.ts AS ts, " + ", ".join(f"round(CAST(f.{c} AS DOUBLE), 6) AS {c}_4H" for c in _LAG_COLUMNS) + f" FROM ({ALL}) h ASOF LEFT JOIN b{len(_LAG_LINES)} f ON h.symbol = f.symbol AND h.ts >= f.ts")

_OBS_LINES, _OBS = hmm.plan(D)
_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in _OBS)
simple("hmm_v1", lambda s, d: rounded(hmm.observations(hourly(s, d))), layers.to_sql(ALL, _OBS_LINES) + f" SELECT symbol, ts, {', '.join(f'round({c}, 6) AS {c}' for c in _OBS)} FROM b{len(_OBS_LINES)} WHERE {_WHOLE}")
simple("hmm_scaled", lambda s, d: rounded(hmm.scaled(hmm.observations(hourly(s, d)), _OBS)), layers.to_sql(ALL, _OBS_LINES) + f" SELECT symbol, ts, {', '.join(f'round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}' for c in _OBS)} FROM b{len(_OBS_LINES)} WHERE {_WHOLE}")

_MULTI = hmm.Observations(("1H", "4H", "1D"), 3)


def _multi_sql() -> str:
    parts = []
    for tf in _MULTI.timeframes:
        made, columns = hmm.plan(D, _MULTI, tf)
        source = ALL if hmm.HOURS[tf] == 1 else bars.right_closed_sql(ALL, hmm.HOURS[tf])
        parts.append(f"({layers.to_sql(source, made)} SELECT symbol, ts, {', '.join(columns)} FROM b{len(made)}) t{tf}")
    joins = " ".join(f"ASOF LEFT JOIN {p} ON h.symbol = {p.split()[-1]}.symbol AND h.ts >= {p.split()[-1]}.ts" for p in parts)
    return f"SELECT h.symbol AS symbol, h.ts AS ts, {', '.join(_MULTI.columns())} FROM ({ALL}) h {joins} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _MULTI.columns())


_MULTI_OUT = ", ".join(f"round({c}, 6) AS {c}" for c in _MULTI.columns())
simple("hmm_multi_tf", lambda s, d: rounded(hmm.observations(hourly(s, d), _MULTI)), f"SELECT symbol, ts, {_MULTI_OUT} FROM ({_multi_sql()})")
simple("hmm_latest", lambda s, d: rounded(hmm.latest(hourly(s, d), _MULTI)), f"SELECT symbol, ts, {_MULTI_OUT} FROM ({_multi_sql()}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) = 1")
simple(
    "hmm_merge_outer",
    lambda s, d: rounded(hmm.merge(hourly(s, d).selectExpr("ts", "close AS close_1H"), bars.right_closed(hourly(s, d), 4).selectExpr("ts", "close AS close_4H"), ["ts"], "outer")),
    f"SELECT ts, round(a.close, 6) AS close_1H, round(b.close, 6) AS close_4H FROM ({ALL}) a FULL JOIN ({bars.right_closed_sql(ALL, 4)}) b USING (ts)",
)

_V2_FROM = [snapshot.returns_basic, snapshot.moving_averages, snapshot.volume_flow]


def current_bars(base: DataFrame, timeframes: tuple[str, ...] = ("1H",)) -> DataFrame:
    """Current-bar columns of each timeframe with its suffix, as of each hour."""
    out = None
    for tf in timeframes:
        made, columns = current_bar.layers(S)
        own = layers.apply(base if hmm.HOURS[tf] == 1 else bars.right_closed(base, hmm.HOURS[tf]), made).select("symbol", "ts", *(F.col(c).alias(f"{c}_{tf}") for c in columns))
        if hmm.HOURS[tf] > 1:
            own = bars.as_of(base.select("symbol", "ts"), own, own.columns[2:])
        out = own if out is None else out.join(own, ["symbol", "ts"])
    return out


def hmm_v2(spark: SparkSession, sf_dir: str, timeframes: tuple[str, ...] = ("1H", "4H")) -> DataFrame:
    base = hourly(spark, sf_dir)
    wanted = [f"{c}_{tf}" for c in hmm.TABLES["v2"][0] for tf in timeframes]
    return hmm.table(features(base, timeframes, wanted=wanted), rounded(current_bars(base, timeframes)), "v2", timeframes, drop_missing=True)


def _hmm_v2_sql(timeframes: tuple[str, ...] = ("1H", "4H")) -> str:
    joins, out = "", []
    for tf in timeframes:
        source = ALL if hmm.HOURS[tf] == 1 else bars.right_closed_sql(ALL, hmm.HOURS[tf])
        made, _ = bundle_sql(source, _V2_FROM)
        lines, _ = current_bar.layers(D)
        joins += f" ASOF LEFT JOIN ({made}) f{tf} ON h.symbol = f{tf}.symbol AND h.ts >= f{tf}.ts"
        joins += f" ASOF LEFT JOIN ({layers.to_sql(source, lines)} SELECT * FROM b{len(lines)}) c{tf} ON h.symbol = c{tf}.symbol AND h.ts >= c{tf}.ts"
        indicators, current = hmm.TABLES["v2"]
        out += [f"f{tf}.{c} AS {c}_{tf}" for c in indicators] + [f"round(CAST(c{tf}.{c} AS DOUBLE), 6) AS {c}_{tf}" for c in current]
    names = [x.split(" AS ")[-1] for x in out]
    return f"SELECT * FROM (SELECT h.symbol AS symbol, h.ts AS ts, {', '.join(out)} FROM ({ALL}) h{joins}) WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in names)


simple("hmm_v2", hmm_v2, _hmm_v2_sql())

#: Hourly bars of a stored lookback.
BASE_ROWS = 168
for _tf, _n in (("4H", "4h"), ("12H", "12h"), ("1D", "1d")):
    simple(
        f"lookback_bars_{_n}",
        lambda s, d, tf=_tf: rounded(lookback.exploded(lookback.lookbacks(hourly(s, d, True), BASE_ROWS, tf))),
        f"SELECT symbol, ts, label, {', '.join(f'round({c}, 6) AS {c}' for c in bars.COLUMNS)} FROM ({lookback.lookbacks_sql(TYPES, BASE_ROWS, hmm.HOURS[_tf])})",
    )
simple(
    "lookback_features_4h",
    lambda s, d: rounded(lookback.at_end(lookback.lookbacks(hourly(s, d), BASE_ROWS, "4H"), current_bar.layers)),
    layers.to_sql(f"SELECT symbol || '@' || upto AS symbol, label AS ts, symbol AS own, upto, open, high, low, close, volume FROM (SELECT symbol, ts AS upto, label, open, high, low, close, volume FROM ({lookback.lookbacks_sql(ALL, BASE_ROWS, 4)}))", current_bar.layers(D)[0])
    + f" SELECT own AS symbol, upto AS ts, {', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in current_bar.layers(D)[1])} FROM b{len(current_bar.layers(D)[0])} QUALIFY row_number() OVER (PARTITION BY own, upto ORDER BY b{len(current_bar.layers(D)[0])}.ts DESC) = 1",
)

_SINGLE = targets.Single("events", horizon=6, up=0.5, down=0.5)


def targets_backfill(spark: SparkSession, sf_dir: str, known: str = "interval 300 hours") -> DataFrame:
    """What a resumed backfill adds to a store that holds the targets of the first 300 hours."""
    base = hourly(spark, sf_dir)
    ends = base.agg(F.min("ts").alias("a"))
    stored = targets.single(base, _SINGLE).crossJoin(F.broadcast(ends)).where(f"ts < a + {known}").drop("a")
    return rounded(targets.backfill_rows(base, stored, _SINGLE, "last_from_targets"))


simple(
    "targets_backfill",
    targets_backfill,
    f"""WITH n AS (SELECT ts, close, high, low, row_number() OVER (ORDER BY ts) AS k, min(ts) OVER () AS a, max(ts) OVER () AS z FROM ({ALL})),
      p AS (SELECT e.ts AS ts, e.a AS a, e.z AS z, f.k AS k, f.high >= e.close * {1 + _SINGLE.up!r} AS up, f.low <= e.close * {1 - _SINGLE.down!r} AS dn FROM n e JOIN n f ON f.k BETWEEN e.k + 1 AND e.k + {_SINGLE.horizon} WHERE e.close > 0),
      t AS (SELECT ts, any_value(a) AS a, any_value(z) AS z, count(*) AS n, arg_min(CASE WHEN up AND NOT dn THEN 1 ELSE 0 END, k) FILTER (up OR dn) AS won FROM p GROUP BY ts),
      m AS (SELECT max(ts) AS last FROM t WHERE ts < a + INTERVAL 300 HOUR AND n = {_SINGLE.horizon})
      SELECT ts, 'events' AS dataset, '{_SINGLE.key}' AS target_key, CAST(coalesce(won, 0) AS DOUBLE) AS target_value FROM t, m
      WHERE n = {_SINGLE.horizon} AND ts >= last + INTERVAL 1 HOUR AND ts <= z - INTERVAL {_SINGLE.horizon} HOUR""",
)

_UNIFIED = "symbol, ts, " + ", ".join(f"round({c}, 6) AS {c}" for names in bars.SOURCES.values() for c in names.values()) + ", round(spot_num_trades, 6) AS spot_num_trades, round(spot_taker_buy_volume, 6) AS spot_taker_buy_volume"
simple("merge_spine_left_join", lambda s, d: rounded(bars.unified(hourly(s, d, True), hourly(s, d))).select("symbol", "ts", *(c for n in bars.SOURCES.values() for c in n.values()), "spot_num_trades", "spot_taker_buy_volume"), f"SELECT {_UNIFIED} FROM ({bars.unified_sql()})")
simple("continuity_check", lambda s, d: bars.continuity(hourly(s, d, True), 24), f"SELECT symbol, ts, n AS n_rows, n AS n_hours, CASE WHEN n = 24 THEN 1 ELSE 0 END AS complete FROM (SELECT symbol, ts, count(*) OVER (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW) AS n FROM ({TYPES}))")
simple("anti_join_skip_existing", lambda s, d: store.missing(hourly(s, d).select("symbol", "ts", "close"), hourly(s, d, True).where("symbol = 'click'").select("ts"), ["ts"]).select("symbol", "ts", "close"), f"SELECT symbol, ts, close FROM ({ALL}) a WHERE NOT EXISTS (SELECT 1 FROM ({TYPES}) b WHERE symbol = 'click' AND a.ts = b.ts)")
simple("semi_join_requested", lambda s, d: hourly(s, d).join(hourly(s, d, True).where("symbol = 'view'").select("ts"), "ts", "left_semi").select("symbol", "ts", "volume"), f"SELECT symbol, ts, volume FROM ({ALL}) a WHERE EXISTS (SELECT 1 FROM ({TYPES}) b WHERE symbol = 'view' AND a.ts = b.ts)")
simple("store_coverage", lambda s, d: hourly(s, d, True).groupBy("symbol").agg(F.count("*").alias("n"), F.countDistinct("ts").alias("n_ts"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")), f"SELECT symbol, count(*) AS n, count(DISTINCT ts) AS n_ts, min(ts) AS first_ts, max(ts) AS last_ts FROM ({TYPES}) GROUP BY symbol")

_RET_LINES, _RET = targets.returns(D)


def targets_long_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, columns = targets.returns(S)
    return rounded(store.to_targets(layers.apply(hourly(spark, sf_dir), made), "events", columns))


simple("targets_long_unpivot", targets_long_unpivot, layers.to_sql(ALL, _RET_LINES) + " " + " UNION ALL ".join(f"SELECT ts, 'events' AS dataset, '{c}' AS target_key, round({c}, 6) AS target_value FROM b{len(_RET_LINES)} WHERE {c} IS NOT NULL" for c in _RET))


def feature_json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, columns = snapshot.returns_basic(S)
    stored = store.to_features(layers.apply(hourly(spark, sf_dir), made), "basic", columns[:6])
    return rounded(store.from_features(stored, columns[:6]))


_B, _BC = snapshot.returns_basic(D)
simple("feature_json_map", feature_json_map, layers.to_sql(ALL, _B) + f" SELECT 'basic' AS feature_key, ts, {', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in _BC[:6])} FROM b{len(_B)}")


def _daily_layers(d: Spark, days: int) -> list[layers.Layer]:
    """A mean over all calendar days up to the day before: days without bars decay what stands before them."""
    gap = f"{'datediff(ts, ' if d is S else 'date_diff(' + chr(39) + 'day' + chr(39) + ', '}{lag('ts') if d is S else lag('ts') + ', ts'})"
    return [{"gap": gap}, {"arr": d.gather(d.pair_where("close", "CAST(close AS DOUBLE)", kept_weight("gap", span(days))), None)}, {"ema": d.folded("arr")}, {"ema_lag": lag("ema")}]


def daily_ema_flag(spark: SparkSession, sf_dir: str, days: int = 5) -> DataFrame:
    """Close over the previous day's exponential mean of daily closes: 1 or 0, 0 where unknown."""
    base = hourly(spark, sf_dir)
    daily = base.groupBy("symbol", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.max_by("close", "ts").alias("close")).select("symbol", F.col("day").alias("ts"), "close")
    made = layers.apply(daily, _daily_layers(S, days)).select("symbol", F.col("ts").alias("day"), "ema_lag")
    joined = base.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")).join(made, ["symbol", "day"], "left")
    return rounded(joined.select("symbol", "ts", "ema_lag", F.coalesce((F.col("close") > F.col("ema_lag")).cast("int"), F.lit(0)).alias("is_above_daily_ema")))


def _daily_sql(days: int = 5) -> str:
    daily = f"SELECT symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, arg_max(close, ts) AS close FROM ({ALL}) GROUP BY 1, 2"
    made = layers.to_sql(daily, _daily_layers(D, days))
    return made + f" SELECT h.symbol AS symbol, h.ts AS ts, round(ema_lag, 6) AS ema_lag, CASE WHEN h.close > ema_lag THEN 1 ELSE 0 END AS is_above_daily_ema FROM ({ALL}) h LEFT JOIN b4 ON h.symbol = b4.symbol AND date_trunc('day', h.ts) = b4.ts"


simple("daily_ema_flag", daily_ema_flag, _daily_sql())


#: Beyond this the survival function of five degrees of freedom is below 1e-22.
FAR = 120


def survival5(q: str) -> str:
    """Chi-square survival with five degrees of freedom: one minus the power series of the incomplete gamma function,
    200 positive terms, folded in the JVM. Right to about 1e-13 absolutely."""
    x = f"({q} / 2)"
    series = f"aggregate(sequence(1, 200), named_struct('t', 1D, 's', 1D), (a, n) -> named_struct('t', a.t * {x} / (2.5D + n), 's', a.s + a.t * {x} / (2.5D + n)), a -> a.s)"
    # 2.5 * 1.5 * 0.5 * sqrt(pi) is the gamma function at 3.5.
    return f"CASE WHEN {q} < 0 THEN NULL WHEN {q} > {FAR} THEN 0D WHEN {q} >= 0 THEN greatest(0D, 1 - power({x}, 2.5D) * exp(-{x}) / (1.875D * sqrt(pi())) * {series}) END"


def ljung_box(spark: SparkSession, sf_dir: str, lags: int = 5, n: int = 100) -> DataFrame:
    """p-value of five autocorrelations over 100 log returns. The numerator of lag k is the sum of
    squares without the first and last k terms, as the results to match have it."""
    made = [*snapshot.BASE, {"rets": S.gather("r", n)}, {"mean_r": f"{S.total('rets', 'x', 'x')} / {n}"}, {"dev": "transform(rets, x -> (x - mean_r) * (x - mean_r))"}]
    made += [{f"a{k}": S.total(f"slice(dev, {k + 1}, {n - 2 * k})", "x", "x") for k in range(lags + 1)}]
    q = f"{n * (n + 2)} * (" + " + ".join(f"power(a{k} / nullif(a0, 0), 2) / {n - k}" for k in range(1, lags + 1)) + ")"
    out = layers.apply(hourly(spark, sf_dir), [*made, {"q": f"CASE WHEN size(rets) >= {n} THEN {q} END"}, {"p": survival5("q")}])
    return out.select("symbol", "ts", F.round("q", 6).alias("q"), F.round("p", 6).alias("close_ljung_p_5_100"))


def _ljung_sql(lags: int = 5, n: int = 100) -> str:
    """From the definitions: each frame's returns by a join, the series by the logarithm of the gamma function."""
    sums = ", ".join(f"sum(d * d) FILTER (i > {k} AND i <= {n - k}) AS a{k}" for k in range(lags + 1))
    q = f"{n * (n + 2)} * (" + " + ".join(f"power(a{k} / nullif(a0, 0), 2) / {n - k}" for k in range(1, lags + 1)) + ")"
    return f"""WITH r AS (SELECT symbol, ts, row_number() OVER o AS k, ln(close / lag(close) OVER o) AS r FROM ({ALL}) WINDOW o AS (PARTITION BY symbol ORDER BY ts)),
      m AS (SELECT a.symbol AS symbol, a.ts AS ts, a.k AS k, avg(b.r) AS mean, count(b.r) AS c FROM r a JOIN r b ON a.symbol = b.symbol AND b.k BETWEEN a.k - {n - 1} AND a.k GROUP BY 1, 2, 3),
      d AS (SELECT m.symbol AS symbol, m.ts AS ts, b.k - m.k + {n} AS i, b.r - mean AS d FROM m JOIN r b ON m.symbol = b.symbol AND b.k BETWEEN m.k - {n - 1} AND m.k WHERE c = {n}),
      s AS (SELECT symbol, ts, {sums} FROM d GROUP BY symbol, ts), q AS (SELECT symbol, ts, {q} AS q FROM s)
      SELECT m.symbol AS symbol, m.ts AS ts, round(q, 6) AS q,
        round(CASE WHEN q > {FAR} THEN 0 WHEN q >= 0 THEN greatest(0, 1 - list_sum(list_transform(range(0, 200), lambda j: exp((2.5 + j) * ln(greatest(q, 1e-300) / 2) - q / 2 - lgamma(3.5 + j))))) END, 6) AS close_ljung_p_5_100
      FROM m LEFT JOIN q ON m.symbol = q.symbol AND m.ts = q.ts"""


simple("ljung_box", ljung_box, _ljung_sql())


def kalman_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Velocity of a two-state filter over closes: sequential, so one Python group for each symbol."""

    def each(pdf):
        pdf = pdf.sort_values("ts")
        x, v, p = None, 0.0, [1.0, 0.0, 0.0, 1.0]
        out = []
        for value in pdf["close"]:
            if x is None:
                x = value
                out.append(None)
                continue
            x += v
            a, b, c, e = p
            a, b, c, e = a + b + c + e + 1e-5, b + e, c + e, e + 1e-5
            if value == value and value is not None:
                s = a + 1e-2
                g, k, res = a / s, c / s, value - x
                x, v = x + g * res, v + k * res
                a, b, c, e = (1 - g) * a, (1 - g) * b, c - k * a, e - k * b
            p = [a, b, c, e]
            out.append(v)
        pdf["kalman_slope"] = out
        return pdf[["symbol", "ts", "kalman_slope"]]

    return rounded(hourly(spark, sf_dir, True).select("symbol", "ts", "close").groupBy("symbol").applyInPandas(each, "symbol string, ts timestamp_ntz, kalman_slope double"))


# The filter step by step, a recursion over row numbers.
simple(
    "kalman_slope",
    kalman_slope,
    f"""WITH RECURSIVE n AS (SELECT symbol, ts, close AS z, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k FROM ({TYPES})),
      f(symbol, k, x, v, a, b, c, e) AS (
        SELECT symbol, k, z, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE FROM n WHERE k = 1
        UNION ALL
        SELECT symbol, k, x + a / s * y, v + c / s * y, (1 - a / s) * a, (1 - a / s) * b, c - c / s * a, e - c / s * b
        FROM (SELECT *, a + 0.01 AS s, z - x AS y FROM (SELECT f.symbol AS symbol, n.k AS k, z, x + v AS x, v, a + b + c + e + 0.00001 AS a, b + e AS b, c + e AS c, e + 0.00001 AS e FROM f JOIN n ON n.symbol = f.symbol AND n.k = f.k + 1)))
      SELECT n.symbol AS symbol, n.ts AS ts, CASE WHEN n.k > 1 THEN round(f.v, 6) END AS kalman_slope FROM n JOIN f ON n.symbol = f.symbol AND n.k = f.k""",
)


def run_fraction(spark: SparkSession, sf_dir: str, n: int = 24) -> DataFrame:
    """Share of the frame's earlier moves that have the current move's sign; NULL unless all n moves are there and none is zero."""
    made = layers.apply(hourly(spark, sf_dir), [{"prev": "lag(close) OVER (PARTITION BY symbol ORDER BY ts)"}, {"sgn": "nullif(sign(close - prev), 0)"}])
    back = Window.partitionBy("symbol").orderBy("ts").rowsBetween(-(n - 1), -1)
    same = F.sum(F.when(F.col("sgn") > 0, 1).otherwise(0)).over(back), F.sum(F.when(F.col("sgn") < 0, 1).otherwise(0)).over(back)
    share = F.when(F.col("sgn") > 0, same[0]).when(F.col("sgn") < 0, same[1])
    whole = F.count("sgn").over(Window.partitionBy("symbol").orderBy("ts").rowsBetween(-(n - 1), 0)) == n
    return rounded(made.select("symbol", "ts", F.when(whole, share / F.lit(n - 1)).alias("run_fraction")))


_RUN = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 23 PRECEDING AND 1 PRECEDING)"
simple(
    "run_fraction",
    run_fraction,
    f"""WITH m AS (SELECT symbol, ts, sign(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts)) AS sgn FROM ({ALL})),
      w AS (SELECT symbol, ts, sgn, list(sgn) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS x FROM m)
      SELECT symbol, ts, CASE WHEN len(list_filter(x, lambda v: v IN (-1, 1))) = 24 THEN round((len(list_filter(x, lambda v: v = sgn)) - 1) / 23.0::DOUBLE, 6) END AS run_fraction FROM w""",
)

