"""Files to bars, history checks, selection modes, merges with absent sources, and a statistic's tail."""

import math

import pytest

from tickloom import queries
from tickloom.operators import store
from tickloom.sources import bars

SCHEMA = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double"


@pytest.fixture(scope="module")
def table(spark):
    return spark.sql("SELECT 'A' symbol, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) ts, id + 1D open, id + 3D high, id + 0D low, id + 2D close, 5D volume FROM range(72)").cache()


@pytest.mark.parametrize("kind", ["csv", "parquet"])
@pytest.mark.parametrize("zoned", [True, False])
def test_read_by_extension_and_range(spark, table, tmp_path, kind, zoned):
    raw = table.selectExpr("cast(ts as timestamp) as Time" if zoned else "ts as Time", "open as Open", "high as HIGH", "low", "close", "volume")
    at = f"{tmp_path}/x.{kind}"
    getattr(raw.coalesce(1).write.option("header", True), kind)(at)
    got = bars.read(spark, at, "2024-01-01 05:00:00", "2024-01-02", symbol="A")
    assert got.columns == table.columns and got.orderBy("ts").collect() == table.where("ts >= timestamp_ntz'2024-01-01 05:00:00' and ts <= timestamp_ntz'2024-01-02 00:00:00'").orderBy("ts").collect()
    assert [r["open"] for r in bars.read(spark, at, limit=2).collect()] == [1.0, 2.0]
    if kind == "parquet" and zoned:  # Spark hands filters on times without a zone to no file
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(Time), GreaterThanOrEqual(Time" in plan
    with pytest.raises(ValueError, match="unsupported"):
        bars.read(spark, f"{tmp_path}/x.xml")


def test_history(spark, table):
    partial = table.union(spark.createDataFrame([("A", __import__("datetime").datetime(2024, 1, 3, 23, 30), 1.0, 1.0, 1.0, 1.0, 1.0)], SCHEMA))
    assert bars.latest_complete(partial).count() == 72
    bars.require_history(table, 71)
    with pytest.raises(ValueError, match="history"):
        bars.require_history(table, 72)


def test_modes(spark, table):
    hours = lambda df: sorted((r["ts"].day - 1) * 24 + r["ts"].hour for r in df.collect())
    now = "2024-01-03 10:20:00"  # closed: up to hour 57
    assert hours(store.window_mode(table, now)) == list(range(10, 58))
    assert hours(store.window_mode(table, now, "2024-01-03 08:00:00", "2024-01-09")) == [56, 57]
    assert hours(store.window_mode(table, now, "2024-01-03", "2024-01-02")) == []
    stored = store.to_features(table.where("ts < timestamp_ntz'2024-01-03 06:00:00'"), "k", ["close"]).union(store.to_features(table, "other", ["close"]))
    assert hours(store.resume_mode(table, stored, now, "k")) == [54, 55, 56, 57]
    assert hours(store.resume_mode(table, stored, now)) == [] and hours(store.resume_mode(table, stored, now, "none")) == list(range(58))
    assert hours(store.list_mode(table, ["2024-01-01 03:00:00", " 2024-01-01 03:00:00", "no time", "2024-01-03 23:00:00", "1999-01-01"], now)) == [3]


def test_absent_sources(spark, table):
    names = {"spot": {"close": "spot_close", "volume": "spot_volume"}, "rates": {"close": "rate"}, "premium": {"open": "p_open", "other": "p_other"}}
    holes = table.where("hour(ts) <> 3").withColumn("close", table["close"] * 2)
    with pytest.warns(UserWarning) as told:
        out = bars.merge_sources(table.select("symbol", "ts"), {"spot": holes.union(holes), "rates": None, "premium": table}, names)
    assert sorted(str(w.message) for w in told) == ["source premium: no p_other", "source rates: no rate"]
    assert out.columns == ["symbol", "ts", "spot_close", "spot_volume", "rate", "p_open", "p_other"] and out.count() == 72
    assert out.where("rate is null and p_other is null and p_open is not null").count() == 72 and out.where("spot_close is null").count() == 3


def test_tail_of_five_degrees(spark):
    values = [0.0, 0.1, 1.0, 4.35, 11.07, 50.0, 119.9, 120.1, 1e6, -1.0, None]
    got = spark.createDataFrame([(i, q) for i, q in enumerate(values)], "i int, q double").selectExpr("i", f"{queries.survival5('q')} p").orderBy("i").collect()
    for q, row in zip(values, got):
        if q is None or q < 0:
            assert row["p"] is None
        else:
            assert abs(row["p"] - (math.erfc(math.sqrt(q / 2)) + math.sqrt(2 * q / math.pi) * math.exp(-q / 2) * (1 + q / 3))) < 1e-12
