"""Structured Streaming front end: left- or right-closed bars from an event stream, features by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources.bars import COLUMNS


def stream_bars(events: DataFrame, hours: int = 1, late: str = "2 hours", closed: str = "left") -> DataFrame:
    """Bars of (event_id, ts, event_type, value); a bar is emitted when the watermark passes its end.

    Closed on the left, a bar is labelled by its start, as hourly bars are; closed on the right, by its end, as resampled bars are.
    """
    if closed not in ("left", "right"):
        raise ValueError(f"unknown side: {closed}")
    at = F.struct("ts", "event_id")
    # A microsecond earlier, the left-closed window is the right-closed one.
    shift = F.expr("interval 1 microsecond") if closed == "right" else F.expr("interval 0 microseconds")
    timed = events.withColumn("ts", F.col("ts").cast("timestamp") - shift).withWatermark("ts", late)
    w = F.window(F.col("ts"), f"{hours} hours")
    made = timed.groupBy(F.col("event_type").alias("symbol"), w.alias("w")).agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count("*").cast("double").alias("volume"))
    return made.select("symbol", F.col("w.start" if closed == "left" else "w.end").cast("timestamp_ntz").alias("ts"), *COLUMNS)


def run(bars: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str):
    """Feed every micro-batch of finished bars to ``each`` (which unites them with history)."""
    return bars.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
