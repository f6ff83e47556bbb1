"""Hand-checked cases for bars, current-bar features and targets."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions import snapshot
from tickloom.functions.dialect import Spark
from tickloom.operators import current_bar, store, targets
from tickloom.plans import layers
from tickloom.sources import bars

T0 = dt.datetime(2024, 1, 1)
S = Spark()


def table(spark, rows, start=T0, symbol="X", hours=1):
    data = [(symbol, start + dt.timedelta(hours=hours * i), *map(float, r)) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double")


def closes(spark, values):
    return table(spark, [(c, c, c, c, 1) for c in values])


def last(df, made):
    return layers.apply(df, made[0]).orderBy("ts").collect()[-1]


def test_right_closed(spark):
    df = table(spark, [(100 + i, 100.5 + i, 99.5 + i, 100.2 + i, 10 * (i + 1)) for i in range(8)])
    got = {r["ts"].hour: r for r in bars.right_closed(df, 4).collect()}
    assert set(got) == {0, 4}
    assert (got[0]["close"], got[0]["volume"]) == (100.2, 10)
    assert (got[4]["open"], got[4]["high"], got[4]["low"], got[4]["close"], got[4]["volume"]) == (101, 104.5, 100.5, 104.2, 140)
    with pytest.raises(ValueError):
        bars.right_closed(df, 5)


def test_empty_bins_and_continuity(spark):
    df = table(spark, [(1, 1, 1, 1, 5)]).union(table(spark, [(2, 2, 2, 2, 7)], T0 + dt.timedelta(hours=3)))
    got = bars.right_closed(df, 1, True).orderBy("ts").collect()
    assert [r["volume"] for r in got] == [5, 0, 0, 7] and got[1]["close"] is None
    assert [r["complete"] for r in bars.continuity(df, 2).orderBy("ts").collect()] == [0, 0]


def test_normalize_keeps_last_and_coerces(spark):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "1", "2", "0.5", "x", "3", 1), ("2024-01-01 00:00:00", "1", "2", "0.5", "NaN", "4", 2), ("bad", "1", "1", "1", "1", "1", 3)], "Time string, Open string, High string, Low string, Close string, Volume string, n int")
    got = bars.normalize(raw, arrival="n").collect()
    assert len(got) == 1 and got[0]["volume"] == 4 and got[0]["close"] is None
    with pytest.raises(ValueError):
        bars.normalize(raw.drop("Open"))


def test_moving_averages_and_macd(spark):
    df = closes(spark, [100, 102, 98, 105, 103])
    assert last(df, snapshot.moving_averages(S))["close_sma_5"] == pytest.approx(101.6)
    from tickloom.functions.dialect import ewm, span

    got = layers.apply(df, [{"a": S.gather("close", 10)}, {"t": ewm(S, "a", span(3), True), "f": ewm(S, "a", span(3), False)}]).orderBy("ts").collect()[-1]
    assert got["t"] == pytest.approx(102.7096774) and got["f"] == pytest.approx(102.625)


def test_indicators_need_history_and_handle_flat_windows(spark):
    flat = closes(spark, [5] * 40)
    got = last(flat, snapshot.oscillators(S))
    assert got["close_stoch_k_14"] == 50 and got["close_williams_r_14"] == -50 and got["close_cci_20"] is None
    assert last(flat, snapshot.extremes_channels(S))["close_position_in_range_20"] == 0.5
    assert last(closes(spark, [5] * 4), snapshot.oscillators(S))["close_stoch_k_14"] is None


def test_current_bar(spark):
    df = table(spark, [(100, 102, 99, 101, 1000), (101, 104, 100, 103, 1100), (102, 105, 101, 104, 900)])
    rows = layers.apply(df, current_bar.layers(S)[0]).orderBy("ts").collect()
    assert rows[0]["close_logret_current"] is None
    assert rows[2]["close_logret_current"] == pytest.approx(math.log(104 / 103))
    assert rows[2]["log_volume_delta_current"] == pytest.approx(math.log1p(900) - math.log1p(1100))
    assert current_bar.lag_name("close_logret_current_x_log_volume", 2) == "close_logret_lag_2_x_log_volume_lag_2"


def test_targets(spark):
    df = closes(spark, [100, 101, 102, 103])
    t = targets.Targets(horizons=(2, 3, 5), logs=True)
    first = layers.apply(df, targets.returns(S, t)[0]).orderBy("ts").first()
    assert first["y_logret_2b"] == pytest.approx(math.log(1.02)) and first["y_logret_5b"] is None


@pytest.mark.parametrize("bars_ahead,ties,want", [
    ([(100, 100.5, 99.8), (100, 102.2, 100.4), (100, 101.5, 100)], "conservative", 1),
    ([(100, 100.5, 98.9), (100, 100.8, 99.2), (100, 100.9, 99.4)], "conservative", -1),
    ([(100, 102.5, 98.5), (100, 100, 100), (100, 100, 100)], "conservative", -1),
    ([(101.9, 102.5, 98.5), (100, 100, 100), (100, 100, 100)], "proximity", 1),
    ([(100, 101, 99.5), (100, 100, 100), (100, 100, 100)], "conservative", 0),
])
def test_barriers(spark, bars_ahead, ties, want):
    df = table(spark, [(100, 100, 100, 100, 1), *((o, h, lo, 100, 1) for o, h, lo in bars_ahead)])
    made, _ = targets.barriers(S, targets.Targets(horizons=(3,), ties=ties))
    row = layers.apply(df, made).orderBy("ts").first()
    assert row["y_tb_label_u0.02_d0.01_3b"] == want


def test_as_of_and_store(spark, tmp_path):
    base, slow = closes(spark, range(1, 10)), table(spark, [(1, 1, 1, 10, 1), (1, 1, 1, 20, 1)], hours=4)
    got = bars.as_of(base, slow, ["close"]).orderBy("ts").collect()
    assert [r["close"] for r in got] == [10] * 4 + [20] * 5
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("k", T0, 1.0)], "feature_key string, ts timestamp_ntz, v double")
    for _ in range(2):
        store.upsert(spark, path, rows, ["feature_key", "ts"])
    store.upsert(spark, path, rows.selectExpr("feature_key", "ts", "2D as v"), ["feature_key", "ts"], overwrite=False)
    assert [r["v"] for r in store.current(spark, path).collect()] == [1.0]


def test_derived_means_run_over_the_whole_series(spark):
    """Two thousand hours against sequential folds; the frames of 720 hours left out older values."""
    from tickloom.functions import derived

    rng = random.Random(9)
    made = [100.0]
    for _ in range(1999):
        made.append(made[-1] * math.exp(rng.gauss(0, 0.02)))
    rows = [(c, c * (1 + rng.random() / 50), c * (1 - rng.random() / 50), c, 1.0) for c in made]
    df = table(spark, rows)
    for c in derived.INPUTS[5:]:
        df = df.withColumn(c, F.col("close"))

    def fold(values, a):
        e = None
        for x in values:
            e = x if e is None else e if x is None else (1 - a) * e + a * x
            yield e

    def close_to(got, want):
        assert all(x is None or y is None or x == pytest.approx(y, rel=1e-7) for x, y in zip(got, want, strict=True)) and got[-1] is not None

    gaps = [None if i % 7 == 3 or i < 5 else c for i, c in enumerate(made)]
    holed = df.withColumn("x", F.when((F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.lit(T0))) / 3600) % 7 != 3) & (F.col("ts") >= F.lit(T0 + dt.timedelta(hours=5))), F.col("close")))
    got = layers.apply(holed, derived.emas(S, {"e24": ("x", 24), "e720": ("x", 720)})).orderBy("ts").collect()
    for n in (24, 720):
        close_to([r[f"e{n}"] for r in got], list(fold(gaps, 2 / (n + 1))))
    gain, loss = ([0.0] + [max(s * (b - a), 0) for a, b in zip(made, made[1:])] for s in (1, -1))
    pdm, mdm, tr = [0.0], [0.0], [rows[0][1] - rows[0][2]]
    for (_, h0, l0, c0, _), (_, h, lo, _, _) in zip(rows, rows[1:]):
        up, down = h - h0, l0 - lo
        pdm.append(up if up > down and up > 0 else 0.0)
        mdm.append(down if down > up and down > 0 else 0.0)
        tr.append(max(h - lo, abs(h - c0), abs(lo - c0)))
    got = layers.apply(df, derived.rsi_adx(S)[0]).orderBy("ts").collect()
    for k in (24, 720):
        g, w, p, m, t = (list(fold(x, 1 / k)) for x in (gain, loss, pdm, mdm, tr))
        close_to([r[f"rsi_{k}"] for r in got], [100 - 100 / (1 + x / y) if y else None for x, y in zip(g, w)])
        dx = [100 * abs(x - y) / (x + y) if i >= k - 1 and x + y else None for i, (x, y) in enumerate(zip(p, m))]
        close_to([r[f"adx_{k}"] for r in got], list(fold(dx, 1 / k)))


def test_streaming_bars_equal_batch(spark, tmp_path):
    from tickloom.streaming.bars import run, stream_bars

    rows = [(i, T0 + dt.timedelta(minutes=17 * i), "a", float(i % 7)) for i in range(60)]
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []
    run(stream_bars(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), lambda df, k: seen.extend(df.collect()), str(tmp_path / "cp")).awaitTermination()
    batch = {r["ts"]: r["volume"] for r in bars.hourly(spark.createDataFrame(rows, schema), True).collect()}
    assert seen and all(batch[r["ts"]] == r["volume"] for r in seen)
