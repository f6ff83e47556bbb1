"""Lookbacks against pandas resampling of each row's last bars, with gaps; their store and checks."""

import numpy as np
import pandas as pd
import pytest
from test_definitions import walk

from tickloom.functions import snapshot
from tickloom.operators import hmm, lookback

RULES = {"4H": "4h", "12H": "12h", "1D": "24h"}


@pytest.fixture(scope="module")
def frames():
    whole = walk("A", 3).iloc[380:620]  # a gap of 60 hours inside
    holes = walk("B", 4).iloc[:100].drop(index=[7, 8, 9, 10, 11, 30, 55, 56])
    holes.loc[20, ["open", "close"]] = np.nan
    return {"A": whole.reset_index(drop=True), "B": holes.reset_index(drop=True)}


@pytest.fixture(scope="module")
def table(spark, frames):
    both = pd.concat(frames.values())
    rows = [[s, ts.to_pydatetime(), *(None if v != v else v for v in values)] for s, ts, *values in both.itertuples(index=False)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double")


def by_pandas(pdf, k, n, tf):
    rows = pdf.iloc[max(0, k - n + 1) : k + 1].set_index("ts").drop(columns="symbol")
    if tf == "1H":
        return rows
    out = rows.resample(RULES[tf], label="right", closed="right").agg({"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum"})
    return out[out.index <= rows.index[-1]]


@pytest.mark.parametrize("tf", ["1H", "4H", "12H", "1D"])
def test_every_row(table, frames, tf):
    got = lookback.lookbacks(table, 50, tf).toPandas()
    for s, pdf in frames.items():
        mine = got[got.symbol == s].sort_values("ts")
        assert list(mine.ts) == list(pdf.ts)
        for k, bars in enumerate(mine.bars):
            want = by_pandas(pdf, k, 50, tf)
            assert [b["label"] for b in bars] == list(want.index)
            have = np.array([[b[c] for c in want.columns] for b in bars], float).reshape(len(want), 5)
            assert np.allclose(have, want.to_numpy(float), equal_nan=True)


def test_trim_and_exactness(spark, frames):
    pdf = walk("A", 5)
    base = spark.createDataFrame(pdf.iloc[:300]).selectExpr("symbol", "cast(ts as timestamp_ntz) ts", "open", "high", "low", "close", "volume")
    for tf, hours in hmm.HOURS.items():
        last = lookback.trimmed(lookback.latest(base, 120 + 24, tf), 120, tf)
        assert last.selectExpr("size(bars)").collect()[0][0] == 120 // hours
        lookback.require_exact(last, 120, tf)
    made = lookback.lookbacks(base, 120, "4H")
    bad = {(r["problem"]) for r in lookback.problems(made, 120, "4H").collect()}
    assert bad == {"length"}  # the first rows
    with pytest.raises(ValueError, match="length"):
        lookback.require_exact(made, 120, "4H")
    holes = made.where("ts = timestamp_ntz'2024-01-12 00:00:00'").selectExpr("symbol", "ts", "transform(bars, x -> named_struct('label', x.label, 'open', nullif(x.open, x.open), 'high', x.high, 'low', x.low, 'close', x.close, 'volume', x.volume)) bars")
    assert [r["problem"] for r in lookback.problems(holes, 120, "4H").collect()] == ["missing values"]
    late = made.where("ts = timestamp_ntz'2024-01-12 00:00:00'").selectExpr("symbol", "ts + interval 4 hours ts", "bars")
    assert [r["problem"] for r in lookback.problems(late, 120, "4H").collect()] == ["alignment"]
    none = made.limit(0)
    assert lookback.problems(none, 120, "4H").count() == lookback.exploded(none).count() == 0


def test_features_of_a_lookback(table, frames):
    made = lookback.lookbacks(table, 120, "4H")
    got = lookback.at_end(made, snapshot.moving_averages).toPandas()
    pdf = frames["A"]
    for k in (100, 237, 239):
        want = by_pandas(pdf, k, 120, "4H").close.iloc[-20:]
        row = got[(got.symbol == "A") & (got.ts == pdf.ts[k])].iloc[0]
        assert len(want) == 20 and not want.isna().any() and np.isclose(row.close_sma_20, want.mean())


def test_store(spark, table, tmp_path):
    at = f"{tmp_path}/store"
    for tf in ("4H", "1D"):
        lookback.store(lookback.lookbacks(table, 48, tf), at, "walks", tf, 48)
    assert sorted(tuple(r) for r in lookback.datasets(spark, at).collect()) == [("walks", "1D"), ("walks", "4H")]
    whole = lookback.scan(spark, at, "walks", "4H")
    assert whole.count() == table.count() and whole.where("lookback_base_rows <> 48 OR row_key <> date_format(ts, 'yyyyMMdd_HHmmss')").count() == 0
    lookback.store(lookback.lookbacks(table, 48, "4H"), at, "walks", "4H", 48)
    assert lookback.scan(spark, at, "walks", "4H").count() == table.count() == lookback.scan(spark, at, "walks", "1D").count()
    part = lookback.scan(spark, at, "walks", "4H", "2024-01-02 05:00:00", "2024-01-03 02:00:00")
    assert part.count() == table.where("ts between timestamp_ntz'2024-01-02 05:00:00' and timestamp_ntz'2024-01-03 02:00:00'").count() > 0
