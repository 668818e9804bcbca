"""Metrics against brute force, folds and splits against hand-made indices."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest

from skyloom.ml import split
from skyloom.operators import evaluate, ranking


def brute_auc(pairs):
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    if not pos or not neg:
        return 0.5
    return sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))


def brute_ap(pairs):
    total = sum(y for _, y in pairs)
    if not total or total == len(pairs):
        return 0.0
    area = 0.0
    for t in sorted({p for p, _ in pairs}, reverse=True):
        called = [y for p, y in pairs if p >= t]
        area += sum(y for p, y in pairs if p == t) / total * (sum(called) / len(called))
    return area


def _pairs(kind):
    rng = random.Random(11)
    if kind == "ties":
        return [(rng.choice([0.1, 0.2, 0.3, 0.9]), int(rng.random() < 0.3)) for _ in range(300)]
    if kind == "hot":  # a third of the rows share one score
        return [(0.0 if i % 3 == 0 else rng.random() ** 6, int(rng.random() < 0.2)) for i in range(400)]
    if kind == "one_class":
        return [(rng.random(), 0) for _ in range(20)]
    return [(rng.random(), int(rng.random() < 0.4)) for _ in range(300)]


@pytest.mark.parametrize("kind", ["random", "ties", "hot", "one_class"])
def test_ranked_metrics_equal_brute_force(spark, kind):
    pairs = _pairs(kind)
    df = spark.createDataFrame(pairs, "prob double, label int")
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert evaluate.average_precision(df).first()[0] == pytest.approx(brute_ap(pairs), abs=1e-12)


def test_metrics_per_group(spark):
    groups = {1: _pairs("ties"), 2: _pairs("random"), 3: _pairs("one_class")}
    df = spark.createDataFrame([(g, p, y) for g, pairs in groups.items() for p, y in pairs], "fold int, prob double, label int")
    got = {r["fold"]: r["roc_auc"] for r in evaluate.roc_auc(df, by="fold").collect()}
    assert got == {g: pytest.approx(brute_auc(p), abs=1e-12) for g, p in groups.items()}


def test_running_totals_do_not_depend_on_the_cuts(spark):
    rng = random.Random(2)
    values = [rng.choice([1.0, 2.0, 2.5, 7.0, 9.0]) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    from pyspark.sql import functions as F

    want = pd.Series(values).value_counts().sort_index().cumsum().to_dict()
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in (*changed, "spark.sql.shuffle.partitions")}
    try:
        for partitions in (1, 2, 3, 11):
            for key, value in (changed | {"spark.sql.shuffle.partitions": str(partitions)}).items():
                spark.conf.set(key, value)
            slices = ranking.ranged(df.distinct(), "v").select("_slice").distinct().count()
            assert slices <= partitions and (slices > 1 or partitions < 3)
            totals = ranking.running_totals(df, "v", {"n": F.count(F.lit(1))}).collect()
            assert {r["v"]: r["cum_n"] for r in totals} == want
            assert {r["all_n"] for r in totals} == {200}
            grouped = df.unionAll(df).withColumn("g", F.when(F.col("v") < 3, "low"))
            found = ranking.running_totals(grouped, "v", {"n": F.count(F.lit(1))}, group="g", descending=True).collect()
            for r in found:
                same = [v for v in values if (v < 3) == (r["g"] == "low")]
                assert (r["cum_n"], r["all_n"]) == (2 * sum(v >= r["v"] for v in same), 2 * len(same))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_thresholds_equal_brute_force(spark):
    pairs = _pairs("random")
    df = spark.createDataFrame(pairs, "prob double, label int")
    best = (0.5, 0.0)
    for row in evaluate.threshold_sweep(df, beta=2.0).orderBy("threshold").collect():
        t = row["threshold"]
        tp, fp = sum(p >= t and y for p, y in pairs), sum(p >= t and not y for p, y in pairs)
        fn = sum(p < t and y for p, y in pairs)
        score = 5 * tp / (5 * tp + 4 * fn + fp) if tp else 0.0
        assert (row["tp"], row["fp"], row["fn"]) == (tp, fp, fn)
        assert row["fbeta"] == pytest.approx(score)
        if score > best[1]:
            best = (t, score)
    assert evaluate.best_threshold(evaluate.threshold_sweep(df, beta=2.0)).first()["threshold"] == best[0]
    none = spark.createDataFrame([(0.2, 0), (0.9, 0)], "prob double, label int")
    assert evaluate.best_threshold(evaluate.threshold_sweep(none)).first()["threshold"] == 0.5


def test_report_and_empty_cells(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0), (0.2, 0)], "prob double, label int")
    assert evaluate.confusion(df, 0.95).count() == 4
    rows = {r["label"]: r for r in evaluate.class_report(df, 0.95).collect()}
    assert (rows[1]["precision"], rows[1]["recall"], rows[1]["support"]) == (0.0, 0.0, 1)
    assert rows[0]["recall"] == 1.0 and rows[0]["precision"] == pytest.approx(2 / 3)


def test_focal_loss(spark):
    pairs = [(0.9, 1), (0.2, 0), (0.0, 1), (1.0, 0), (0.5, 1)]
    want = np.mean([
        (0.8 if y else 0.2) * (1 - (p if y else 1 - p)) ** 1.5 * min(100.0, -math.log(p if y else 1 - p) if (p if y else 1 - p) > 0 else 100.0)
        for p, y in pairs])
    got = evaluate.focal_loss(spark.createDataFrame(pairs, "prob double, label int")).first()[0]
    assert got == pytest.approx(want)


def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(4)
    table = pd.DataFrame({"a": rng.normal(size=501), "b": np.repeat([1.0, 5.0, 5.0], 167)})
    df = spark.createDataFrame(table)
    want = table.describe()
    for row in evaluate.describe(df, ["a", "b"]).collect():
        c = want[row["column"]]
        got = [row[k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        np.testing.assert_allclose(got, c.to_numpy(), rtol=1e-9)
    sketch = {r["column"]: r["q50"] for r in evaluate.describe(df, ["a", "b"], exact=False).collect()}
    assert sketch["b"] == 5.0 and abs(sketch["a"] - want["a"]["50%"]) < 0.05


def test_early_stop(spark):
    metric = [0.1, 0.3, 0.2, 0.25, 0.3, 0.29, 0.4]
    df = spark.createDataFrame([("r", i + 1, m) for i, m in enumerate(metric)], "run string, epoch int, auc_pr double")
    rows = evaluate.early_stop(df, patience=3).orderBy("epoch").collect()
    assert [r["since_best"] for r in rows] == [0, 0, 1, 2, 3, 4, 0]
    assert [r["stopped"] for r in rows] == [0, 0, 0, 0, 1, 1, 1]
    assert rows[-1]["best"] == 0.4


def _series(spark, n):
    return spark.createDataFrame([(1, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(n)], "site_id int, date date, a double")


@pytest.mark.parametrize("n", [23, 24, 30])
@pytest.mark.parametrize("site", [None, "site_id"])
def test_folds(spark, n, site):
    folds = {r["position"]: r["fold"] for r in split.ts_folds(_series(spark, n), 5, site).collect()}
    size = n // 6
    for i in range(5):
        start = n - (5 - i) * size
        assert [p for p, f in folds.items() if f == i + 1] and sorted(p for p, f in folds.items() if f == i + 1) == list(range(start, start + size))
    members = split.fold_membership(split.ts_folds(_series(spark, n), 5, site)).groupBy("in_fold", "role").count().collect()
    got = {(r["in_fold"], r["role"]): r["count"] for r in members}
    assert got == {(i + 1, role): (size if role == "test" else n - (5 - i) * size) for i in range(5) for role in ("train", "test")}


def test_split_has_a_gap_only_before_validation(spark):
    rows = split.temporal_split(_series(spark, 100), 0.7, 0.1, gap=3).orderBy("date").collect()
    assert [r["split"] for r in rows] == ["train"] * 70 + ["gap"] * 3 + ["val"] * 7 + ["test"] * 20
    # 0.7 + 0.1 is below 0.8 in binary, which moves the cut of ten rows
    assert [r["split"] for r in split.temporal_split(_series(spark, 10), 0.7, 0.1, gap=0).orderBy("date").collect()] == ["train"] * 7 + ["test"] * 3


def test_gap_is_counted_in_dates_when_sites_share_them(spark):
    rows = [(site, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for site in range(7) for d in range(50)]
    df = spark.createDataFrame(rows, "site_id int, date date")
    parts = {r["date"]: r["split"] for r in split.temporal_split(df, 0.5, 0.4, gap=14).collect()}
    order = [parts[d] for d in sorted(parts)]
    assert order == ["train"] * 25 + ["gap"] * 14 + ["val"] * 6 + ["test"] * 5


def test_split_keeps_a_date_together(spark):
    df = spark.createDataFrame([(s, dt.date(2020, 1, 1) + dt.timedelta(days=d)) for s in range(7) for d in range(10)], "site_id int, date date")
    parts = split.temporal_split(df, gap=0).groupBy("date").agg({"split": "collect_set"}).collect()
    assert all(len(r[1]) == 1 for r in parts)


def test_scaler_uses_population_deviation_of_train(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (100.0, 6.0)], "a double, b double")
    stats = split.fit_scaler(df.filter("a < 50"), ["a", "b"])
    rows = split.apply_scaler(df, stats, ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [(-1.0, 0.0), (1.0, 0.0), (98.0, 1.0)]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 0, 1)], "site_id int, a double, event_heat int, target int")
    assert split.feature_columns(df) == ["a"]
    assert split.align_columns(df, ["z", "a"], keep=["site_id"]).first().asDict() == {"site_id": 1, "z": 0.0, "a": 2.0}
    assert split.require_columns(df, ["a", "z"], strict=False) == (["a"], ["z"])
    with pytest.raises(ValueError, match="z"):
        split.require_columns(df, ["a", "z"])


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "target int")
    assert sorted(r["weight"] for r in split.class_weights(df).collect()) == pytest.approx([2 / 3] * 3 + [2.0])
