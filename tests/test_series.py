"""Sub-daily and daily windows against pandas twins, with skew, gaps, ties and shuffled input."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.operators import daily, features, series, windows

START = dt.datetime(2024, 3, 30)


@pytest.fixture(scope="module")
def skewed():
    """Two thirds of the rows in one site, equal timestamps, long silences."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        site = 1 if rng.random() < 0.66 else int(rng.integers(2, 8))
        minute = int(rng.integers(0, 3)) + 60 * 24 * int(rng.integers(0, 5)) if site == 1 else int(rng.integers(0, 20000))
        value = None if rng.random() < 0.03 else float(np.round(rng.random() * 10, 3))
        rows.append((site, START + dt.timedelta(minutes=minute), i, value))
    return pd.DataFrame(rows, columns=["site_id", "ts", "event_id", "v"])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("slots", [1, 60, 1440])
def test_deaccumulate_equals_pandas(spark, skewed, kind, slots):
    df = spark.createDataFrame(skewed.sample(frac=1, random_state=1)).withColumn("ts", F.col("ts").cast(kind))
    df = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = series.deaccumulate(df, "v", "out", slots=slots).select("event_id", "out").toPandas()
    want = skewed.sort_values(["site_id", "ts", "event_id"]).copy()
    want["out"] = want.groupby("site_id")["v"].diff().clip(lower=0) * 1000
    merged = got.merge(want[["event_id", "out"]], on="event_id", suffixes=("", "_want"))
    assert len(merged) == len(skewed)
    np.testing.assert_allclose(merged["out"].astype(float), merged["out_want"].astype(float), rtol=1e-12)


def test_previous_value_in_a_zone_with_clock_changes(spark, skewed):
    """Slots must follow the instant, not the wall clock of the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        df = spark.createDataFrame(skewed).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        got = series.previous_value(df, "event_id", "prev").select("event_id", "prev").toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = skewed.sort_values(["site_id", "ts", "event_id"])
    want = want.assign(prev=want.groupby("site_id")["event_id"].shift(1))[["event_id", "prev"]]
    merged = got.merge(want, on="event_id", suffixes=("", "_want"))
    np.testing.assert_array_equal(merged["prev"].astype(float), merged["prev_want"].astype(float))


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    rows = [
        (s, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(rng.random()), None if rng.random() < 0.1 else float(rng.random()))
        for s in (1, 2, 3) for d in range(40) if rng.random() < 0.8
    ]
    return pd.DataFrame(rows, columns=["site_id", "date", "a", "b"])


def _frame(spark, table):
    shuffled = table.sample(frac=1, random_state=2)
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in shuffled.itertuples(index=False)]
    return spark.createDataFrame(rows, "site_id int, date date, a double, b double")


@pytest.mark.parametrize("min_periods", [None, 1])
def test_rolling_equals_pandas(spark, table, min_periods):
    got = windows.rolling_mean(_frame(spark, table), ["a", "b"], [3, 7], min_periods).toPandas().sort_values(["site_id", "date"])
    for c in ("a", "b"):
        for n in (3, 7):
            want = table.groupby("site_id")[c].rolling(n, min_periods=min_periods).mean().to_numpy()
            np.testing.assert_allclose(got[f"{c}_ma{n}"].astype(float).to_numpy(), want, rtol=1e-12)


def test_lags_gradients_targets(spark, table):
    df = windows.lags(_frame(spark, table), ["a"], [1, 3])
    df = windows.gradient(windows.gradient(df, "a", "g"), "a", "g0", fill=0.0)
    got = windows.next_target(df, "a", "next").toPandas().sort_values(["site_id", "date"])
    by = table.groupby("site_id")["a"]
    for name, want in {"a_lag1": by.shift(1), "a_lag3": by.shift(3), "g": by.diff(), "g0": by.diff().fillna(0), "next": by.shift(-1)}.items():
        np.testing.assert_allclose(got[name].astype(float).to_numpy(), want.to_numpy(), rtol=1e-12)


def test_segments_stop_windows(spark):
    days = [dt.date(1990, 12, 30), dt.date(1990, 12, 31), dt.date(2010, 1, 1), dt.date(2010, 1, 2)]
    df = spark.createDataFrame([(1, d, float(i)) for i, d in enumerate(days)], "site_id int, date date, a double")
    got = windows.lags(windows.segments(df, 30), ["a"], [1], site=["site_id", "segment"]).orderBy("date").collect()
    assert [(r["segment"], r["a_lag1"]) for r in got] == [(0, None), (0, 0.0), (1, None), (1, 2.0)]


def test_sequences_exclude_current_row_unless_asked(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(6)], "site_id int, date date, a double")
    past = windows.sequences(df, ["a"], 3).orderBy("date").collect()
    assert [[s[0] for s in r["seq"]] for r in past] == [[0, 1, 2], [1, 2, 3], [2, 3, 4]]
    here = windows.sequences(df, ["a"], 3, include_current=True).orderBy("date").collect()
    assert [s[0] for s in here[-1]["seq"]] == [3, 4, 5]
    newest = windows.newest_sequence(df, ["a"], 3).collect()
    assert [[s[0] for s in r["seq"]] for r in newest] == [[3, 4, 5]]
    assert windows.newest_sequence(df, ["a"], 7).count() == 0


def test_grid_boxes_and_merge(spark):
    t = dt.datetime(2024, 1, 1)
    instant = spark.createDataFrame([(t, 1.0, 1.0, 10.0), (t, 1.0, 2.0, 20.0), (t, 9.0, 9.0, 99.0)],
                                    "valid_time timestamp, latitude double, longitude double, t2m double")
    accum = spark.createDataFrame([(t, 1.0, 1.0, 0.1), (t, 1.0, 2.0, 0.3)],
                                  "valid_time timestamp, latitude double, longitude double, tp double")
    merged = series.merge_grid(instant, accum)
    assert merged.count() == 2
    means = series.grid_mean(merged, [("s", 2.0, 0.0, 0.0, 2.0), ("t", 2.0, 0.0, 0.0, 1.0)]).orderBy("site_id").collect()
    assert [(r["site_id"], r["t2m"], round(r["tp"], 6)) for r in means] == [("s", 15.0, 0.2), ("t", 10.0, 0.1)]
    whole = series.rename_grid(series.grid_mean(merged)).first()
    assert (whole["ts"], whole["temp_k"]) == (t, 15.0)


def test_boxes_equal_plain_comparison(spark):
    """Overlapping, empty, huge and point-sized boxes; cells on edges, below zero and nowhere; tiles of any size."""
    rng = np.random.default_rng(6)
    cells = [(float(a), float(b)) for a, b in rng.integers(-40, 40, (300, 2)) / 4] + [(90.0, -180.0)]
    boxes = [(k, *sorted(rng.integers(-40, 40, 2) / 4)[::-1], *rng.integers(-40, 40, 2) / 4) for k in range(40)]
    boxes = [(k, float(n), float(min(w, e)), float(s), float(max(w, e))) for k, n, s, w, e in boxes]
    boxes += [(40, 90.0, -180.0, -90.0, 180.0), (41, 1.0, 1.0, 1.0, 1.0), (42, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(cells, "latitude double, longitude double").distinct()
    want = {(k, a, b) for a, b in cells for k, n, w, s, e in boxes if s <= a <= n and w <= b <= e}
    table = spark.createDataFrame(boxes, "site_id int, north double, west double, south double, east double")
    for tile, given in ((1.0, boxes), (0.25, boxes), (7.0, table)):
        got = [tuple(r) for r in series.box_cells(df, given, tile).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_zscore_modes_agree_with_pandas(spark, table):
    df = _frame(spark, table)
    for stats, want in {
        "site": (table["a"] - table.groupby("site_id")["a"].transform("mean")) / table.groupby("site_id")["a"].transform("std"),
        "all": (table["a"] - table["a"].mean()) / table["a"].std(),
        (0.5, 2.0): (table["a"] - 0.5) / 2.0,
    }.items():
        got = features.zscore(df, "a", "z", stats).toPandas().sort_values(["site_id", "date"])
        np.testing.assert_allclose(got["z"].to_numpy(), want.to_numpy(), rtol=1e-10)


def test_missing_sources_are_skipped(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5.0)], "site_id int, date date, temp_c double")
    assert daily.daily_sequence(df).columns == ["site_id", "date", "temp_c"]
    featured = features.add_sequence_features(daily.daily_sequence(df))
    assert featured.first()["dry_index"] == 0.0
    assert "pressure_ma3" not in featured.columns
    with pytest.raises(ValueError):
        daily.enough_history(df, 2, strict=True)
