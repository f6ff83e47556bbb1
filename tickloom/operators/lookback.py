"""Lookbacks: for every bar the bars of a timeframe made of the last N hourly bars only.

The oldest bin of a lookback holds just the hourly bars that are inside it, so it may be partial; an unfinished
bin at the end is left out; bins without bars have NULL prices and volume 0. A symbol's hourly bars number a few
hundred thousand at most, however many events they are made of, so frames go by symbol.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.dialect import Spark
from tickloom.operators.hmm import HOURS
from tickloom.plans import layers
from tickloom.sources.bars import COLUMNS

#: One bar of a lookback.
BAR = "struct<label:timestamp_ntz,open:double,high:double,low:double,close:double,volume:double>"


def _bar(window: Window, label: str) -> F.Column:
    """The bar of a frame; NULL prices are passed over."""
    prices = {"open": F.first("open", True), "high": F.max("high"), "low": F.min("low"), "close": F.last("close", True)}
    volume = F.coalesce(F.sum("volume").over(window), F.lit(0.0))
    return F.struct(F.col(label).alias("label"), *(v.over(window).alias(c) for c, v in prices.items()), volume.alias("volume"))


def lookbacks(bars: DataFrame, rows: int, tf: str) -> DataFrame:
    """(symbol, ts, bars): the ``tf`` bars of the last ``rows`` hourly bars up to each bar, oldest first.

    A bin's whole bar stands on the last of its rows, so a frame over rows gathers just the bins that end in it;
    the oldest of them is replaced by what the frame holds of it. No join; all frames share one shuffle by symbol.
    """
    hours = HOURS[tf]
    order = Window.partitionBy("symbol").orderBy("ts")
    back = order.rowsBetween(-(rows - 1), 0)
    if hours == 1:
        bar = F.struct(F.col("ts").alias("label"), *(F.col(c).cast("double").alias(c) for c in COLUMNS))
        return bars.select("symbol", "ts", F.collect_list(bar).over(back).alias("bars"))
    step = hours * 3_600_000_000
    at = "unix_micros(cast(ts as timestamp))"
    put = "cast(timestamp_micros({}) as timestamp_ntz)"
    marked = bars.withColumn("label", F.expr(put.format(f"cast(ceil({at} / {step}D) as bigint) * {step}"))).withColumn("floor", F.expr(put.format(f"cast(floor({at} / {step}D) as bigint) * {step}")))
    own = Window.partitionBy("symbol", "label").orderBy("ts")
    rest = _bar(own.rowsBetween(0, Window.unboundedFollowing), "label")
    whole = _bar(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), "label")
    made = marked.select("symbol", "ts", "floor", rest.alias("rest"), F.when(F.lead("ts").over(own).isNull(), whole).alias("whole"))
    held = made.select("symbol", "ts", "floor", F.first("rest").over(back).alias("oldest"), F.collect_list("whole").over(back).alias("ended"))
    done = held.select("symbol", "ts", "floor", F.expr("CASE WHEN oldest.label <= ts THEN concat(array(oldest), filter(ended, x -> x.label > oldest.label AND x.label <= ts)) ELSE slice(ended, 1, 0) END").alias("done"))
    return done.select("symbol", "ts", F.expr(_filled(hours)).alias("bars"))


def _filled(hours: int) -> str:
    """Bins without bars between those of ``done``, and up to ``floor``; untouched where there are none."""
    each = f"interval {hours} hours"
    none = f"l -> cast(named_struct('label', l, 'open', null, 'high', null, 'low', null, 'close', null, 'volume', 0D) as {BAR})"
    between = f"transform(filter(sequence(done[i - 1].label, x.label, {each}), l -> l > done[i - 1].label AND l < x.label), {none})"
    after = f"transform(filter(sequence(element_at(done, -1).label, floor, {each}), l -> l > element_at(done, -1).label), {none})"
    inner = f"flatten(transform(done, (x, i) -> CASE WHEN i = 0 THEN array(x) ELSE concat({between}, array(x)) END))"
    return f"CASE WHEN size(done) = 0 OR floor = done[0].label + {each} * (size(done) - 1) THEN done ELSE concat({inner}, {after}) END"


def trimmed(lookbacks: DataFrame, base_hours: int, tf: str) -> DataFrame:
    """The last ``base_hours`` worth of bars of each lookback, what a longer buffer adds left out."""
    most = max(1, base_hours // HOURS[tf])
    return lookbacks.withColumn("bars", F.expr(f"slice(bars, greatest(1, size(bars) - {most - 1}), {most})"))


def problems(lookbacks: DataFrame, base_hours: int, tf: str) -> DataFrame:
    """(symbol, ts, problem) of the lookbacks that are not exact: empty, of a wrong length, not ending at the last
    bin's end, or with a missing value."""
    most, step = max(1, base_hours // HOURS[tf]), HOURS[tf] * 3_600_000_000
    floor = f"cast(timestamp_micros(cast(floor(unix_micros(cast(ts as timestamp)) / {step}D) as bigint) * {step}) as timestamp_ntz)"
    lost = " OR ".join(f"x.{c} IS NULL" for c in COLUMNS)
    found = F.expr(f"""CASE WHEN coalesce(size(bars), 0) <= 0 THEN 'empty' WHEN size(bars) <> {most} THEN 'length'
      WHEN element_at(bars, -1).label <> {floor} THEN 'alignment' WHEN exists(bars, x -> {lost}) THEN 'missing values' END""")
    return lookbacks.select("symbol", "ts", found.alias("problem")).where("problem IS NOT NULL")


def require_exact(lookbacks: DataFrame, base_hours: int, tf: str) -> None:
    """ValueError with a few of the problems, if there are any."""
    some = problems(lookbacks, base_hours, tf).orderBy("symbol", "ts").limit(10).collect()
    if some:
        raise ValueError(f"{tf} lookbacks are not exact: " + ", ".join(f"{r['symbol']} {r['ts']} {r['problem']}" for r in some))


def exploded(lookbacks: DataFrame) -> DataFrame:
    """(symbol, ts, label, open, ...): a row for each bar of each lookback."""
    return lookbacks.select("symbol", "ts", F.explode("bars").alias("x")).select("symbol", "ts", "x.*")


def at_end(lookbacks: DataFrame, plan: Callable) -> DataFrame:
    """A layered plan over each lookback by itself, as of its last bar; lookbacks without bars have no row.

    Every lookback is a series of its own, so its partial oldest bin counts and nothing before it does.
    """
    made, columns = plan(Spark())
    rows = exploded(lookbacks).select(F.struct("symbol", "ts").alias("symbol"), F.col("label").alias("ts"), *COLUMNS)
    names = [f"`{c}`" for c in columns]
    last = layers.apply(rows, made).select("symbol", "ts", *names).groupBy("symbol").agg(F.max_by(F.struct(*names), "ts").alias("x"))
    return last.select("symbol.symbol", "symbol.ts", *(F.col(f"x.`{c}`").alias(c) for c in columns))


def latest(bars: DataFrame, rows: int, tf: str) -> DataFrame:
    """The lookback of each symbol's last bar."""
    last = Window.partitionBy("symbol").orderBy(F.desc("ts"))
    tail = bars.withColumn("__k", F.row_number().over(last)).where(f"__k <= {rows}").drop("__k")
    return lookbacks(tail, rows, tf).groupBy("symbol").agg(F.max("ts").alias("ts"), F.max_by("bars", "ts").alias("bars"))


def store(lookbacks: DataFrame, path: str, dataset: str, tf: str, rows: int) -> None:
    """Write the lookbacks of a dataset and timeframe, a folder for each day; days written again are replaced."""
    keyed = lookbacks.select(
        "symbol", "ts", F.date_format("ts", "yyyyMMdd_HHmmss").alias("row_key"), F.lit(rows).alias("lookback_base_rows"), "bars",
        F.lit(dataset).alias("dataset"), F.lit(tf).alias("timeframe"), F.to_date("ts").alias("day"),
    )
    keyed.repartition("day").write.mode("overwrite").partitionBy("dataset", "timeframe", "day").option("partitionOverwriteMode", "dynamic").parquet(path)


def scan(spark: SparkSession, path: str, dataset: str, tf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Stored lookbacks with ts in [start, end]; only the folders of the range are read."""
    out = spark.read.parquet(path).where((F.col("dataset") == dataset) & (F.col("timeframe") == tf))
    if start:
        out = out.where((F.col("day") >= F.lit(start).cast("date")) & (F.col("ts") >= F.lit(start).cast("timestamp_ntz")))
    if end:
        out = out.where((F.col("day") <= F.lit(end).cast("date")) & (F.col("ts") <= F.lit(end).cast("timestamp_ntz")))
    return out.drop("dataset", "timeframe", "day")


def datasets(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, timeframe) of a store, from its folders."""
    return spark.read.parquet(path).select("dataset", "timeframe").distinct()


def lookbacks_sql(bars: str, rows: int, hours: int) -> str:
    """The exploded lookbacks from their definition: each row's last ``rows`` bars, binned anew."""
    step = hours * 3_600_000_000
    floor = f"make_timestamp(CAST(floor(epoch_us(upto) / {step}::DOUBLE) AS BIGINT) * {step})"
    return f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k FROM ({bars})),
      p AS (SELECT a.symbol AS symbol, a.ts AS upto, b.ts AS ts, b.open AS open, b.high AS high, b.low AS low, b.close AS close, b.volume AS volume,
        make_timestamp(CAST(ceil(epoch_us(b.ts) / {step}::DOUBLE) AS BIGINT) * {step}) AS label
        FROM n a JOIN n b ON a.symbol = b.symbol AND b.k BETWEEN a.k - {rows - 1} AND a.k),
      g AS (SELECT symbol, upto, label, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close, sum(volume) AS volume FROM p GROUP BY symbol, upto, label),
      s AS (SELECT symbol, upto, unnest(generate_series(min(label), {floor}, INTERVAL {hours} HOUR)) AS label FROM p GROUP BY symbol, upto)
      SELECT s.symbol AS symbol, s.upto AS ts, s.label AS label, open, high, low, close, coalesce(volume, 0) AS volume FROM s LEFT JOIN g ON s.symbol = g.symbol AND s.upto = g.upto AND s.label = g.label"""
