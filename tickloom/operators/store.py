"""Keyed stores: features as JSON maps, targets as long rows; upsert, skip-existing, selection modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_features(wide: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(feature_key, ts, features): one JSON map a row, missing values as null."""
    return wide.select(F.lit(key).alias("feature_key"), "ts", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("features"))


def from_features(stored: DataFrame, columns: list[str]) -> DataFrame:
    kinds = ", ".join(f"`{c}` double" for c in columns)
    return stored.select("feature_key", "ts", F.from_json("features", kinds).alias("f")).select("feature_key", "ts", *(F.col(f"f.`{c}`").alias(c) for c in columns))


def to_targets(wide: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """(ts, dataset, target_key, target_value): finite values only."""
    long = wide.select("ts", *(F.col(f"`{c}`").cast("double").alias(c) for c in columns)).unpivot(["ts"], [F.col(f"`{c}`") for c in columns], "target_key", "target_value")
    return long.where("target_value is not null and not isnan(target_value) and abs(target_value) < double('inf')").select("ts", F.lit(dataset).alias("dataset"), "target_key", "target_value")


def missing(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key the store has not."""
    return new.join(old.select(*keys).distinct(), keys, "left_anti")


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The store after an upsert: new rows replace old ones of the same key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], overwrite: bool = True) -> None:
    """Idempotent write: the next version is written beside the store, then takes its place by version number."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    versions = sorted(int(x.getPath().getName()[2:]) for x in fs.listStatus(at) if x.getPath().getName().startswith("v=")) if fs.exists(at) else []
    done = [v for v in versions if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={v}/_SUCCESS"))]
    if done:
        old = spark.read.parquet(f"{path}/v={done[-1]}")
        new = merged(old, new, keys) if overwrite else old.unionByName(missing(new, old, keys), allowMissingColumns=True)
    new.write.mode("overwrite").parquet(f"{path}/v={(versions[-1] if versions else 0) + 1}")


def current(spark: SparkSession, path: str) -> DataFrame:
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(path))]
    done = [int(n[2:]) for n in names if n.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return spark.read.parquet(f"{path}/v={max(done)}")


def window_mode(bars: DataFrame, now: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Closed bars (at least an hour old at ``now``) in [start, end]; by default the last 48 hours."""
    cutoff = F.expr(f"date_trunc('hour', timestamp_ntz '{now}') - interval 1 hour").cast("timestamp_ntz")
    last = F.least(F.lit(end).cast("timestamp_ntz"), cutoff) if end else cutoff
    first = F.lit(start).cast("timestamp_ntz") if start else last - F.expr("interval 47 hours")
    return bars.where((F.col("ts") >= first) & (F.col("ts") <= last))


def resume_mode(bars: DataFrame, stored: DataFrame, now: str, key: str | None = None) -> DataFrame:
    """Closed bars after the last stored time (of one feature key, if given)."""
    last = (stored.where(F.col("feature_key") == key) if key else stored).agg(F.max("ts").alias("__last"))
    return window_mode(bars, now, start="0001-01-01").crossJoin(F.broadcast(last)).where("__last is null or ts > __last").drop("__last")


def list_mode(bars: DataFrame, wanted: list[str], now: str) -> DataFrame:
    """Closed bars among the wanted times; entries that are no times are dropped."""
    spark = bars.sparkSession
    times = spark.createDataFrame([(x.strip(),) for x in wanted], "t string").select(F.expr("try_cast(t as timestamp_ntz)").alias("ts")).dropna().distinct()
    return window_mode(bars, now, start="0001-01-01").join(times, "ts", "left_semi")


def write(df: DataFrame, path: str, kind: str = "parquet", created: bool = False) -> None:
    """Sink by kind (parquet or csv with a header); ``created`` adds created_at, the time of writing. A day is a folder."""
    if kind not in ("parquet", "csv"):
        raise ValueError(f"unsupported format: {kind}")
    out = df.withColumn("created_at", F.current_timestamp()) if created else df
    out = out.withColumn("day", F.to_date("ts"))
    # Days that are written again are replaced, the others stay.
    to = out.repartition("day").write.mode("overwrite").partitionBy("day").option("partitionOverwriteMode", "dynamic")
    to.option("header", True).csv(path) if kind == "csv" else to.parquet(path)


def days(spark: SparkSession, path: str) -> DataFrame | None:
    """A store whose days are folders, or None where there is none yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not (fs.exists(at) and any(x.getPath().getName().startswith("day=") for x in fs.listStatus(at))):
        return None
    return spark.read.parquet(path).drop("day")


def upsert_days(spark: SparkSession, path: str, new: DataFrame, keys: list[str]) -> int:
    """Idempotent write that touches only the days of ``new``: their old rows and the new ones replace them when the job
    commits. Returns the number of new rows. One writer at a time.

    The new rows are written beside the store first, so what is merged does not depend on what is replaced.
    """
    beside = f"{path.rstrip('/')}.new"
    new.withColumn("day", F.to_date("ts")).write.mode("overwrite").parquet(beside)
    rows = spark.read.parquet(beside)
    count = rows.count()
    if count and days(spark, path) is not None:
        # The days come from a written table, whose size Spark knows: it broadcasts them only if they are few.
        old = spark.read.parquet(path).join(rows.select("day").distinct(), "day", "left_semi")
        rows = merged(old, rows, keys)
    if count:
        rows.repartition("day").write.mode("overwrite").partitionBy("day").option("partitionOverwriteMode", "dynamic").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(beside)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return count


def read_range(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of a written Parquet table with ts in [start, end]: only the days of the range are read."""
    out = spark.read.parquet(path)
    if start:
        out = out.where((F.col("day") >= F.lit(start).cast("date")) & (F.col("ts") >= F.lit(start).cast("timestamp_ntz")))
    if end:
        out = out.where((F.col("day") <= F.lit(end).cast("date")) & (F.col("ts") <= F.lit(end).cast("timestamp_ntz")))
    return out.drop("day")


def with_targets(predictions: DataFrame, targets: DataFrame) -> DataFrame:
    """Predictions (ts, target_key, ...) beside the stored value of their target; NULL where it is not known yet."""
    known = targets.select("ts", "target_key", "target_value")
    return predictions.join(known, ["ts", "target_key"], "left")
