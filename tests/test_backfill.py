"""Target backfills and observation tables: modes, labels, pairs, stores written day by day."""

import pandas as pd
import pytest
from test_definitions import walk

from tickloom import queries
from tickloom.operators import hmm, store, targets

ONE = targets.Single("walks", horizon=6, up=0.02, down=0.01)


@pytest.fixture(scope="module")
def frame():
    return walk("A", 7).iloc[:300].reset_index(drop=True)


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).selectExpr("symbol", "cast(ts as timestamp_ntz) ts", "open", "high", "low", "close", "volume").cache()


def value(frame, k, t):
    ahead = frame.iloc[k + 1 : k + 1 + t.horizon]
    if len(ahead) < t.horizon:
        return None
    up, down = frame.close[k] * (1 + t.up), frame.close[k] * (1 - t.down)
    for high, low in zip(ahead.high, ahead.low):
        if high >= up or low <= down:
            return float(high >= up and low > down)
    return 0.0


def test_labels_and_pairs():
    assert [targets.label_of(f) for f in ("1H", "4h", "15T", "min", "1D", "W", None)] == ["h", "h", "min", "min", "d", "b", "b"]
    assert targets.parse_pairs(["0.04:0.02", "1:0.5"]) == ((0.04, 0.02), (1.0, 0.5))
    for bad in ("0.04", "0.04:0", "-1:1", "a:b"):
        with pytest.raises(ValueError):
            targets.parse_pairs([bad])
    assert ONE.key == "y_tp_before_sl_u0.02_d0.01_6h"


def test_backfill_modes(spark, table, frame, tmp_path):
    at = f"{tmp_path}/targets"
    want = {ts: value(frame, k, ONE) for k, ts in enumerate(frame.ts) if value(frame, k, ONE) is not None}
    assert set(want.values()) == {0.0, 1.0}
    window = {"mode": "window", "start": str(frame.ts[10]), "end": str(frame.ts[99])}
    with pytest.raises(ValueError, match="no stored"):
        targets.backfill(spark, at, table, ONE, mode="last_from_targets")
    assert targets.backfill(spark, at, table, ONE, dry_run=True, **window) == 90 and store.days(spark, at) is None
    assert targets.backfill(spark, at, table, ONE, at_most=30, **window) == 30
    assert targets.backfill(spark, at, table, ONE, **window) == 60
    assert targets.backfill(spark, at, table, ONE, **window) == 0
    assert targets.backfill(spark, at, table, ONE, force=True, **window) == 90
    assert targets.backfill(spark, at, table, ONE, mode="ts_list", wanted=[str(frame.ts[3]), "no time", str(frame.ts[20]), "1999-01-01"]) == 1
    assert targets.backfill(spark, at, table, ONE, mode="last_from_targets") == 300 - 6 - 100
    other = targets.Single("walks", horizon=12, up=0.02, down=0.01)
    assert targets.backfill(spark, at, table, other, **window) == 90
    got = store.days(spark, at).toPandas()
    mine = got[got.target_key == ONE.key]
    assert dict(zip(mine.ts, mine.target_value)) == {ts: v for ts, v in want.items() if ts >= frame.ts[10] or ts == frame.ts[3]}
    assert len(got) == len(mine) + 90 and got.created_at.notna().all() and not got.duplicated(["ts", "dataset", "target_key"]).any()
    for bad in ({"mode": "window", "start": "2024-01-01"}, {"mode": "ts_list"}, {"mode": "nothing"}):
        with pytest.raises(ValueError):
            targets.backfill(spark, at, table, ONE, **bad)


def test_upsert_touches_only_its_days(spark, tmp_path):
    at = f"{tmp_path}/s"
    rows = [(pd.Timestamp(f"2024-01-0{d} 0{h}:00:00").to_pydatetime(), float(d)) for d in (1, 2, 3) for h in (1, 2)]
    assert store.upsert_days(spark, at, spark.createDataFrame(rows, "ts timestamp_ntz, x double"), ["ts"]) == 6
    files = {f.name for f in (tmp_path / "s" / "day=2024-01-01").iterdir()}
    assert store.upsert_days(spark, at, spark.createDataFrame([(rows[2][0], 9.0)], "ts timestamp_ntz, x double"), ["ts"]) == 1
    assert sorted(r["x"] for r in store.days(spark, at).collect()) == [1.0, 1.0, 2.0, 3.0, 3.0, 9.0]
    assert files == {f.name for f in (tmp_path / "s" / "day=2024-01-01").iterdir()}
    assert store.upsert_days(spark, at, spark.createDataFrame([], "ts timestamp_ntz, x double"), ["ts"]) == 0


def test_observation_tables(table):
    wanted = [f"{c}_1H" for version in ("v1", "v2") for c in hmm.TABLES[version][0]]
    features, current = queries.features(table, wanted=wanted), queries.current_bars(table)
    v2 = hmm.table(features, current)
    assert v2.columns == ["symbol", "ts", *(f"{c}_1H" for c in hmm.TABLES["v2"][0] + hmm.TABLES["v2"][1])] and v2.count() == 300
    assert 0 < hmm.table(features, current, drop_missing=True).count() < 300
    with pytest.warns(UserWarning, match="no such columns"):
        v1 = hmm.table(features.drop("close_parkinson_20_1H"), current, "v1", how="left")
    assert v1.columns == ["symbol", "ts", "close_logret_current_1H", "log_volume_delta_current_1H"]
    with pytest.raises(ValueError, match="not unique"):
        hmm.table(features.union(features), current)
