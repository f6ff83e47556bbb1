"""Bars: from events or files to validated, gap-aware OHLCV tables.

Columns: symbol, ts (timestamp_ntz), open, high, low, close, volume (double).
"""

from __future__ import annotations

import warnings
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COLUMNS = ["open", "high", "low", "close", "volume"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value")


def hourly(events: DataFrame, by_type: bool = False) -> DataFrame:
    """One bar for each symbol and hour; equal times are ordered by event_id."""
    at = F.struct("ts", "event_id")
    symbol = F.col("event_type") if by_type else F.lit("ALL")
    return (
        events.groupBy(symbol.alias("symbol"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bar"))
        .agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count("*").cast("double").alias("volume"))
        .select("symbol", F.col("bar").alias("ts"), *COLUMNS)
    )


def hourly_sql(by_type: bool = False) -> str:
    symbol = "event_type" if by_type else "'ALL'"
    return f"SELECT {symbol} AS symbol, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2"


def time_column(df: DataFrame) -> str:
    lower = {c.lower(): c for c in df.columns}
    return next((lower[c] for c in ("timestamp", "time", "datetime", "date", "ts", "index") if c in lower), df.columns[0])


def normalize(df: DataFrame, symbol: str = "ALL", arrival: str | None = None) -> DataFrame:
    """Any table with OHLCV columns (in any case, text or numbers) to bars.

    The time column is the first of timestamp, time, datetime, date, ts, index. Values that are no
    numbers, or are not finite, become NULL; rows without a time go; of equal times the last
    arrival stays (``arrival`` names the column that says so; else the greatest values).
    """
    lower = {c.lower(): c for c in df.columns}
    time = time_column(df)
    missing = [c for c in COLUMNS if c not in lower]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    number = lambda c: F.expr(f"CASE WHEN isnan(try_cast(`{lower[c]}` AS DOUBLE)) OR abs(try_cast(`{lower[c]}` AS DOUBLE)) = double('inf') THEN NULL ELSE try_cast(`{lower[c]}` AS DOUBLE) END").alias(c)
    own = F.col(lower["symbol"]) if "symbol" in lower else F.lit(symbol)
    ts = F.expr(f"try_cast(`{time}` AS TIMESTAMP_NTZ)") if dict(df.dtypes)[time] != "timestamp" else F.to_utc_timestamp(time, df.sparkSession.conf.get("spark.sql.session.timeZone")).cast("timestamp_ntz")
    rows = df.select(own.alias("symbol"), ts.alias("ts"), *(number(c) for c in COLUMNS), (F.col(arrival) if arrival else F.lit(0)).alias("__n")).where("ts is not null")
    last = Window.partitionBy("symbol", "ts").orderBy(F.desc("__n"), *(F.desc(c) for c in COLUMNS))
    return rows.withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k", "__n")


def read(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, limit: int | None = None, **options) -> DataFrame:
    """Bars from csv, txt, parquet or pq by extension; the time range is inclusive."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("csv", "txt"):
        raw = spark.read.option("header", True).csv(path)
    elif kind in ("parquet", "pq"):
        raw = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format: {kind}")
    time = time_column(raw)
    kind = dict(raw.dtypes)[time]
    for bound, above in ((start, True), (end, False)):
        if bound and kind.startswith("timestamp"):  # on the file's own column, so that the scan skips what is outside
            at = F.lit(bound).cast("timestamp_ntz") if kind == "timestamp_ntz" else F.lit(datetime.fromisoformat(bound).isoformat() + "Z").cast("timestamp")
            raw = raw.where(F.col(f"`{time}`") >= at if above else F.col(f"`{time}`") <= at)
    bars = normalize(raw, **options)
    if start:
        bars = bars.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        bars = bars.where(F.col("ts") <= F.lit(end).cast("timestamp_ntz"))
    return bars.orderBy("symbol", "ts").limit(limit) if limit else bars


def _micros(ts: str) -> str:
    return f"unix_micros(cast({ts} as timestamp))"


def right_closed(bars: DataFrame, hours: int, empty: bool = False) -> DataFrame:
    """Bars of ``hours`` labelled by their right end, closed there; unfinished bins are left out.

    ``hours`` must divide a day. With ``empty``, gaps give bins without prices and volume 0.
    Bins are aligned to the epoch in UTC.
    """
    if 24 % hours:
        raise ValueError("hours must divide 24")
    step = hours * 3_600_000_000
    label = F.expr(f"cast(timestamp_micros(cast(ceil({_micros('ts')} / {step}D) as bigint) * {step}) as timestamp_ntz)")
    made = bars.groupBy("symbol", label.alias("label")).agg(F.max("ts").alias("last"), F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "ts").alias("close"), F.sum("volume").alias("volume"))
    # A symbol's last time, from its bins: the bars are read once.
    out = made.withColumn("last", F.max("last").over(Window.partitionBy("symbol"))).where("label <= last").select("symbol", F.col("label").alias("ts"), *COLUMNS)
    if not empty:
        return out
    ends = out.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    spine = ends.select("symbol", F.explode(F.expr(f"sequence(a, b, interval {hours} hours)")).alias("ts"))
    return spine.join(out, ["symbol", "ts"], "left").withColumn("volume", F.coalesce("volume", F.lit(0.0)))


def right_closed_sql(bars: str, hours: int, empty: bool = False) -> str:
    step = hours * 3_600_000_000
    made = f"""SELECT b.symbol AS symbol, label AS ts, arg_min(open, b.ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, b.ts) AS close, sum(volume) AS volume
      FROM (SELECT *, make_timestamp(CAST(ceil(epoch_us(ts) / {step}::DOUBLE) AS BIGINT) * {step}) AS label, max(ts) OVER (PARTITION BY symbol) AS last FROM ({bars})) b WHERE label <= last GROUP BY 1, 2"""
    if not empty:
        return made
    return f"""SELECT s.symbol AS symbol, s.ts AS ts, open, high, low, close, coalesce(volume, 0) AS volume FROM
      (SELECT symbol, unnest(generate_series(min(ts), max(ts), INTERVAL {hours} HOUR)) AS ts FROM ({made}) GROUP BY symbol) s LEFT JOIN ({made}) m ON s.symbol = m.symbol AND s.ts = m.ts"""


def spine(bars: DataFrame) -> DataFrame:
    """Every hour between a symbol's first and last bar."""
    ends = bars.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("symbol", F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("ts"))


def as_of(base: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """For each base row the last ``other`` row at or before it: one union, one window, no range join."""
    left = base.select("symbol", "ts", F.lit(1).alias("__side"), F.lit(None).cast(other.select(F.struct(*columns)).schema[0].dataType).alias("__row"))
    right = other.select("symbol", "ts", F.lit(0).alias("__side"), F.struct(*columns).alias("__row"))
    back = Window.partitionBy("symbol").orderBy("ts", "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(right).withColumn("__row", F.last("__row", True).over(back)).where("__side = 1")
    return both.select("symbol", "ts", *(F.col(f"__row.{c}").alias(c) for c in columns))


def continuity(bars: DataFrame, hours: int) -> DataFrame:
    """(symbol, ts, n_rows, n_hours, complete): are the last ``hours`` hours up to each bar all there, once each?"""
    seconds = F.expr("unix_seconds(cast(ts as timestamp))")
    back = Window.partitionBy("symbol").orderBy("s").rangeBetween(-(hours - 1) * 3600, 0)
    before = F.lag("s").over(Window.partitionBy("symbol").orderBy("s"))
    marked = bars.withColumn("s", seconds).withColumn("first", F.when(before == F.col("s"), 0).otherwise(1).cast("long"))  # repeats of an hour count once
    out = marked.select("symbol", "ts", F.count("*").over(back).alias("n_rows"), F.sum("first").over(back).alias("n_hours"))
    return out.withColumn("complete", ((F.col("n_rows") == hours) & (F.col("n_hours") == hours)).cast("int"))


def latest_complete(bars: DataFrame) -> DataFrame:
    """Bars up to the last whole hour of their symbol."""
    last = bars.groupBy("symbol").agg(F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("last"))
    return bars.join(last, "symbol").where("ts <= last").drop("last")


def require_history(bars: DataFrame, hours: int) -> None:
    """ValueError if a symbol's bars do not reach ``hours`` back from its last one."""
    short = bars.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).where(F.expr(f"a > b - interval {hours} hours")).count()
    if short:
        raise ValueError(f"{short} symbols have less than {hours} hours of history")


#: The event type that stands for each source of the merged table, and the names its columns get.
SOURCES = {
    "click": {"open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume"},
    "view": {"close": "sum_open_interest", "volume": "sum_open_interest_value"},
    "purchase": {"close": "long_short_ratio", "high": "long_account", "low": "short_account"},
    "signup": {"open": "premium_idx_open", "high": "premium_idx_high", "low": "premium_idx_low", "close": "premium_idx_close"},
    "error": {"open": "spot_open", "high": "spot_high", "low": "spot_low", "close": "spot_close", "volume": "spot_volume"},
}


def unified(by_type: DataFrame, whole: DataFrame) -> DataFrame:
    """Hourly spine with one left join for each source; a missing hour has NULLs.

    Trade counts and taker volumes are derived: trades = spot volume, taker buys = half of it times high over (high + low).
    """
    # All sources in one aggregation: a source has an hour once, so the maximum is its value.
    value = [F.max(F.when(F.col("symbol") == kind, F.col(a))).alias(b) for kind, names in SOURCES.items() for a, b in names.items()]
    out = spine(whole).join(by_type.where(F.col("symbol").isin(*SOURCES)).groupBy("ts").agg(*value), "ts", "left")
    return out.withColumn("spot_num_trades", F.col("spot_volume") + 1).withColumn("spot_taker_buy_volume", F.expr("spot_volume * spot_high / nullif(spot_high + spot_low, 0)"))


def merge_sources(base: DataFrame, sources: dict[str, DataFrame | None], names: dict[str, dict[str, str]]) -> DataFrame:
    """``base`` (symbol, ts) with each source's columns under their names here, one left join a source by (symbol, ts).

    A source that is not there, or a column that it lacks, is warned of and gives NULLs; of a source's rows with one
    key the greatest values stay.
    """
    out = base
    for source, columns in names.items():
        df = sources.get(source)
        have = {a: b for a, b in columns.items() if df is not None and a in df.columns}
        lost = [b for a, b in columns.items() if a not in have]
        if lost:
            warnings.warn(f"source {source}: no {', '.join(lost)}", stacklevel=2)
        if have:
            out = out.join(df.groupBy("symbol", "ts").agg(*(F.max(a).cast("double").alias(b) for a, b in have.items())), ["symbol", "ts"], "left")
        out = out.select("*", *(F.lit(None).cast("double").alias(b) for b in lost))
    return out.select(*base.columns, *(b for columns in names.values() for b in columns.values()))


def unified_sql() -> str:
    joins = " ".join(f"LEFT JOIN (SELECT ts, {', '.join(f'{a} AS {b}' for a, b in names.items())} FROM ({hourly_sql(True)}) WHERE symbol = '{kind}') {kind}_t ON s.ts = {kind}_t.ts" for kind, names in SOURCES.items())
    columns = ", ".join(b for names in SOURCES.values() for b in names.values())
    return f"""SELECT s.symbol AS symbol, s.ts AS ts, {columns}, spot_volume + 1 AS spot_num_trades, spot_volume * spot_high / nullif(spot_high + spot_low, 0) AS spot_taker_buy_volume
      FROM (SELECT 'ALL' AS symbol, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS ts FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t FROM events)) s {joins}"""
