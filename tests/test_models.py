"""Models on planted signals; attributions against enumeration; saved artefacts."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.ml import attribution, epochs, forest, perceptron, scoring, sequence_model
from skyloom.operators import evaluate, features
from skyloom.plans import flows, model_queries
from skyloom.session import work_path
from skyloom.sources import tables

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(600):
        a, b, c = (float(v) for v in rng.random(3))
        rows.append((1, dt.date(2020, 1, 1) + dt.timedelta(days=i), a, b, c, int(a + 0.3 * b > 0.9 or rng.random() < 0.03)))
    return spark.createDataFrame(rows, "site_id int, date date, a double, b double, c double, target int").cache()


@pytest.fixture(scope="module")
def model(planted):
    return forest.fit_forest(planted, COLS, trees=5, depth=4)


def test_cross_validation_finds_the_signal(planted):
    scored, metrics = forest.cross_validate(planted, COLS, k=3, trees=5, depth=4)
    assert scored.count() == 450
    assert all(r["auc"] > 0.8 for r in metrics.collect())
    assert metrics.count() == 3


def test_forest_keeps_nodes_between_levels_and_grows_the_same_trees(planted, model):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    from skyloom.ml.split import class_weights

    fitted = model.stages[-1]
    assert fitted.getCacheNodeIds() and fitted.getCheckpointInterval() == -1
    walked = RandomForestClassifier(
        labelCol="target", weightCol="weight", numTrees=5, maxDepth=4, minInstancesPerNode=K.FOREST_MIN_LEAF, seed=K.SEED).fit(
        VectorAssembler(inputCols=COLS, outputCol="features").transform(class_weights(planted)))
    assert walked.toDebugString.split("\n", 1)[1] == fitted.toDebugString.split("\n", 1)[1]


def test_attributions_add_up_and_match_enumeration(planted, model, spark):
    sample = attribution.first_rows(planted, "date", n=6)
    long = attribution.attributions(model, sample, COLS, ["date"])
    totals = long.groupBy("date").agg((F.sum("value") + F.first("base")).alias("total"))
    probs = forest.score(model, sample)
    for r in totals.join(probs, "date").collect():
        assert r["total"] == pytest.approx(r["prob"], abs=1e-9)

    leaves = [
        (group.value[i], list(zip(group.feature[i], group.low[i], group.high[i], group.share[i])))
        for group in attribution.pack_leaves(attribution.forest_nodes(model, spark), len(COLS)) for i in range(len(group.value))]

    def payoff(row, coalition):
        return sum(
            value * math.prod((float(lo < row[f] <= hi) if f in coalition else share) for f, lo, hi, share in path)
            for value, path in leaves) / 5

    row = sample.first()
    x = [row[c] for c in COLS]
    got = {r["feature"]: r["value"] for r in long.filter(F.col("date") == row["date"]).collect()}
    for i, name in enumerate(COLS):
        others = [j for j in range(3) if j != i]
        want = sum(
            math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (payoff(x, {*s, i}) - payoff(x, set(s)))
            for n in range(3) for s in itertools.combinations(others, n))
        assert got[name] == pytest.approx(want, abs=1e-9)


def test_long_paths_match_enumeration():
    """Paths of up to seven features, where the integral needs several nodes; leaves in more than one block of rows."""
    rng = np.random.default_rng(4)
    width = 7
    packed = []
    for n in (1, 4, 7):
        low = rng.choice([-np.inf, 0.2, 0.4], (5, n))
        packed.append(attribution.Leaves(
            rng.random(5), np.stack([rng.permutation(width)[:n] for _ in range(5)]), low, np.full((5, n), 0.8), rng.uniform(0.01, 1.0, (5, n))))
    x = rng.random((4, width))
    got, base = attribution.explain(x, packed, 2)

    def payoff(row, coalition):
        return sum(
            g.value[i] * math.prod(
                float(g.low[i, j] < row[f] <= g.high[i, j]) if f in coalition else g.share[i, j] for j, f in enumerate(g.feature[i]))
            for g in packed for i in range(5)) / 2

    assert base == pytest.approx(payoff(x[0], set()), abs=1e-12)
    for row, values in zip(x, got):
        worth = {c: payoff(row, set(c)) for n in range(width + 1) for c in itertools.combinations(range(width), n)}
        for i in range(width):
            want = sum(
                math.factorial(len(c)) * math.factorial(width - 1 - len(c)) / math.factorial(width)
                * (worth[tuple(sorted((*c, i)))] - worth[c]) for c in worth if i not in c)
            assert values[i] == pytest.approx(want, abs=1e-12)


def test_values_looked_up_by_pattern_equal_the_integrals(monkeypatch):
    """Blocks of many rows share the values of a leaf; cuts, infinite and missing values among the rows."""
    rng = np.random.default_rng(8)
    width, packed = 6, []
    for n in (0, 1, 3, 6):
        feature = np.stack([rng.permutation(width)[:n] for _ in range(9)]).reshape(9, n)
        low, high = rng.choice([-np.inf, 0.2, 0.4], (9, n)), rng.choice([0.6, 0.8, np.inf], (9, n))
        packed.append(attribution.Leaves(rng.random(9), feature, low, high, rng.uniform(0.01, 1.0, (9, n))))
    x = rng.choice([0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, np.nan, np.inf, -np.inf], (500, width))
    assert len(x) >= attribution.SHARED << width
    walked = []
    direct = attribution._explain_leaves
    monkeypatch.setattr(attribution, "_explain_leaves", lambda *a: walked.append(len(a[0])) or direct(*a))
    got, base = attribution.explain(x, packed, 3)
    assert not walked
    parts = [attribution.explain(x[at:at + 1], packed, 3) for at in range(len(x))]
    assert walked
    assert np.allclose(got, np.concatenate([p[0] for p in parts]), rtol=0, atol=1e-12) and all(p[1] == base for p in parts)


def test_metrics_and_model_round_trip(planted, model, spark):
    scored = forest.score(model, planted).withColumn("fold", F.lit(1))
    metrics = forest.metric_rows(scored)
    top = evaluate.attribution_summary(attribution.attributions(model, attribution.first_rows(planted, "date", n=50), COLS, ["date"]))
    assert top.first()["feature"] == "a"
    summary = planted.agg(F.lit(3).alias("n_features"), F.count(F.lit(1)).alias("n_samples"), F.avg("target").alias("event_rate"))
    path = work_path(spark, "metrics")
    tables.write_metrics(tables.metrics_record(metrics, top, summary, "forest"), path)
    row = tables.read_metrics(spark, path).first()
    assert (row["model"], row["n_features"], row["n_samples"], len(row["folds"]), len(row["top_features"])) == ("forest", 3, 600, 1, 3)
    assert row["top_features"][0]["feature"] == "a" and row["mean_auc"] > 0.8

    path = work_path(spark, "model")
    sequence_model.save_model(path, model, COLS, spark, kind="forest")
    loaded, meta = sequence_model.load_model(path, spark)
    assert meta == {"cols": COLS, "kind": "forest"}
    again = forest.score(loaded, planted).agg(F.sum("prob")).first()[0]
    assert again == pytest.approx(scored.agg(F.sum("prob")).first()[0])


@pytest.mark.parametrize("kind", ["perceptron", "logistic"])
def test_sequence_model(spark, kind):
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i), float((i + s) % 4), int((i + s) % 4 == 3)) for s in range(3) for i in range(120)]
    table = spark.createDataFrame(rows, "site_id int, date date, a double, target int")
    fitted, held_out = sequence_model.fit_sequence(table, ["a"], length=4, kind=kind, hidden=(8,), iterations=60, gap=4)
    test = held_out.filter(F.col("split") == "test")
    assert evaluate.roc_auc(test, label="target").first()[0] > 0.95
    path = work_path(spark, "sequence")
    sequence_model.save_sequence_model(path, fitted, spark)
    loaded = sequence_model.load_sequence_model(path, spark)
    newest = sequence_model.score_sequence(loaded, table).collect()
    assert len(newest) == 3 and all(r["prediction"] in (0, 1) for r in newest)
    assert sequence_model.score_sequence(loaded, table.filter("date < '2020-01-03'")).count() == 0


def test_perceptron_takes_the_steps_of_mllib(spark, monkeypatch):
    """Passes over blocks give the weights of MLlib's fit, whose last block of a partition is smaller; MLlib itself takes no step."""
    rows = [([math.sin(i * k) for k in range(1, 7)], float((i * 7) % 10 < 3 + (i % 3))) for i in range(700)]
    data = spark.createDataFrame(rows, "x array<double>, target double").repartition(3).select(
        array_to_vector("x").alias("features"), "target").cache()
    layers, settings = [6, 5, 3, 2], {"featuresCol": "features", "labelCol": "target", "seed": 9}
    want = {n: MultilayerPerceptronClassifier(layers=layers, maxIter=n, **settings).fit(data) for n in (1, 6, 12)}
    untouched = MultilayerPerceptronClassifier(layers=layers, maxIter=5, **settings).fit(data.where("false"))
    asked, fit = [], MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", lambda self, df: asked.append(self.getMaxIter()) or fit(self, df))
    for n, other in want.items():
        model = perceptron.fit_perceptron(data, layers, n, 9)
        assert np.allclose(model.weights.toArray(), other.weights.toArray(), rtol=1e-6, atol=1e-9)
        assert model.getMaxIter() == n and not model.isDefined(model.initialWeights)
    assert set(asked) == {0}
    for some in (data.limit(1), data, data.coalesce(1), data.unionAll(data).coalesce(1)):
        rows, n = [len(y) // 8 for _, y in perceptron.packed(some, 6).collect()], some.count()
        assert sum(rows) == n and max(rows) <= perceptron.BLOCK and sum(r % perceptron.STACK > 0 for r in rows) <= some.rdd.getNumPartitions()
    none = perceptron.fit_perceptron(data.where("false"), layers, 5, 9)
    assert np.array_equal(none.weights.toArray(), untouched.weights.toArray())


def test_line_search_and_steps_without_spark():
    """A valley with a bend: the search brackets, zooms and forgets; no number makes it go back; a hill ends the run."""
    def valley(x):
        a, b = x
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert np.allclose(perceptron.minimise(valley, np.array([-1.2, 1.0]), 200, 1e-12), [1, 1], atol=1e-4)
    seen = []

    def walled(x):
        seen.append(x[0])
        return (math.nan if abs(x[0]) > 3 else (x[0] - 2.5) ** 2), np.array([2 * (x[0] - 2.5)])

    assert perceptron.minimise(walled, np.array([-2.9]), 50, 1e-12)[0] == pytest.approx(2.5)
    start = np.array([0.5, 0.5])
    assert np.array_equal(perceptron.minimise(lambda x: (math.nan, x * math.nan), start, 5, 1e-6), start)


def _features(spark, sites):
    return spark.createDataFrame([(s,) for s in sites], "site_id int").select(
        "site_id", F.lit(dt.date(2024, 1, 1)).alias("date"), *[F.lit(1.0).alias(c) for c in K.FOREST_FEATURES])


def test_fallback_order_and_missing_model(spark):
    sites = spark.createDataFrame([(1,), (2,), (3,), (4,)], "site_id int")
    readings = spark.createDataFrame([(1, 40.0), (2, 40.0), (3, 40.0)], "site_id int, temperature double").select(
        "site_id", F.lit(dt.date(2024, 1, 1)).alias("date"), "temperature", F.lit(1010.0).alias("pressure"),
        F.lit(1.0).alias("wind_speed"), F.lit(50.0).alias("humidity"), F.lit(10.0).alias("clouds"))
    args = (sites, _features(spark, [1]), _features(spark, [1, 2]), readings)
    chosen = {r["site_id"]: (r["source"], r["event_type"]) for r in scoring.choose_input(*args).collect()}
    assert chosen == {1: ("history", "cold"), 2: ("stored", "cold"), 3: ("reading", "heat"), 4: (None, None)}
    idle = scoring.score_with_fallback(*args, model=None).collect()
    assert [(r["risk_score"], r["event_type"], r["ready"]) for r in idle] == [(0.0, "unknown", False)] * 4


def test_queries_run_the_library_defaults(monkeypatch):
    """No query fits a smaller model or shorter windows than the constants say."""
    assert (model_queries.TREES, model_queries.DEPTH) == (K.FOREST_TREES, K.FOREST_DEPTH)
    seen = []

    class Seen(Exception):
        pass

    def fit(table, *args, **settings):
        seen.append((args, settings))
        raise Seen

    for where, name in ((model_queries, "durable"), (model_queries.B, "readings"), (flows, "sequence_features"),
                        (flows, "sequence_daily"), (features, "add_sequence_features"), (features, "sequence_targets")):
        monkeypatch.setattr(where, name, lambda *args: None)
    monkeypatch.setattr(sequence_model, "fit_sequence", fit)
    for query in (model_queries.m6_sequence_scores, model_queries.m7_sequence_decisions):
        with pytest.raises(Seen):
            query(None, None)
    assert seen == [((), {}), ((), {"kind": "logistic"})]
    assert (K.EPOCHS, K.PATIENCE, K.HIDDEN_UNITS) == (150, 25, (128, 64))


@pytest.mark.parametrize("name, number", [("m1_forest_probabilities", "prob"), ("m7_sequence_decisions", "prob"),
                                          ("m9_fallback_risks", "risk_score"), ("t5_stream_risks", "risk_score")])
def test_queries_return_the_numbers_of_the_model(spark, sf, name, number):
    """The scores themselves, not only checks of them; a forest has more than one number."""
    rows = model_queries.__dict__[name](spark, sf).collect()
    values = [r[number] for r in rows if r[number] is not None]
    assert values and all(0 <= v <= 1 for v in values)
    if name == "m7_sequence_decisions":  # rounded, these are 0 for every site of the smallest tables
        assert len(values) == len(rows) and all((r["prob"] >= round(r["threshold"], 4)) == (r["prediction"] == 1) for r in rows)
        return
    assert len(set(values)) > 1
    if name != "m1_forest_probabilities":
        assert all(r["event_type"] for r in rows)


def _series(spark, days=240, sites=4):
    """The day after a high value has the event; the second column is noise."""
    import random

    rng = random.Random(3)
    rows = []
    for site in range(sites):
        high = 0
        for k in range(days):
            value = rng.random()
            rows.append((site, dt.date(2020, 1, 1) + dt.timedelta(k), value, rng.random(), int(high)))
            high = value > 0.8
    return spark.createDataFrame(rows, "site_id int, date date, a double, b double, target int")


def test_epochs_learn_stop_and_keep_the_best(spark):
    table = _series(spark)
    model, history_, held_out = epochs.fit_epochs(table, ["a", "b"], length=3, hidden=(8, 4), epochs=22, patience=4, rate=0.03)
    rows = history_.orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[-1]["loss"] < rows[0]["loss"]
    # the flags are those of W16, and no epoch follows the one that stops
    again = evaluate.early_stop(history_.select(F.lit(0).alias("run"), "epoch", "auc_pr"), patience=4).orderBy("epoch").collect()
    assert [(r["best"], r["since_best"], r["stopped"]) for r in rows] == [(r["best"], r["since_best"], r["stopped"]) for r in again]
    assert all(r["stopped"] == 0 for r in rows[:-1]) and (len(rows) == 22 or rows[-1]["stopped"] == 1)
    assert model.best_epoch == next(r["epoch"] for r in rows if r["auc_pr"] == max(q["auc_pr"] for q in rows))
    assert model.state == "validated" and 0 < model.threshold < 1
    test = held_out.where("split = 'test'")
    value = evaluate.average_precision(test, label="target").first()["average_precision"]
    assert value > 2 * test.agg(F.avg("target")).first()[0]
    # the kept weights are those of the best epoch
    kept = evaluate.average_precision(held_out.where("split = 'val'"), label="target").first()["average_precision"]
    assert abs(kept - rows[model.best_epoch - 1]["auc_pr"]) < 1e-9


def test_epochs_without_validation_windows(spark):
    model, history_, held_out = epochs.fit_epochs(_series(spark, days=40), ["a", "b"], length=3, hidden=(4,), epochs=2)
    assert model.state == "no validation rows" and model.threshold == K.DEFAULT_THRESHOLD and model.best_epoch == 2
    assert history_.count() == 2 and {r["split"] for r in held_out.select("split").distinct().collect()} == {"test"}


def test_blocks_hold_every_window_and_deal_them_evenly(spark, monkeypatch):
    """One partition has all windows; passes get them in even tasks and sum what one matrix gives."""
    monkeypatch.setattr(epochs, "BLOCK_VALUES", 60)  # 20 windows of 3 numbers
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(1000, 3)), rng.integers(0, 2, 1000)
    rows = [([float(v) for v in a], int(t), float(k % 3 + 1)) for k, (a, t) in enumerate(zip(x, y))]
    windows_ = spark.createDataFrame(rows, "features array<double>, target int, w double").coalesce(1)
    fed, files = epochs._blocks(windows_, F.col("w"), 3)
    cores = spark.sparkContext.defaultParallelism
    assert files == min(epochs.SHARES * cores, 50)
    with epochs._evenly(spark, files):
        sizes = [r["n"] for r in fed.groupBy(F.spark_partition_id()).agg(F.sum("rows").alias("n")).collect()]
    assert sum(sizes) == 1000 and len(sizes) >= files // 2 and max(sizes) <= 80
    network = epochs.Perceptron((3, 4, 1))
    weights = network.start(2)
    gradient, loss, n = epochs._summed(fed, files, network, weights, 0.8, 2.0)
    whole, total = network.gradient(weights, x, y, np.arange(1000) % 3 + 1.0, 0.8, 2.0)
    assert n == 1000 and np.allclose(gradient, whole / 1000) and abs(loss - total / 1000) < 1e-12
    found = {r["epoch"]: r["auc_pr"] for r in epochs._precision(fed, files, network, [(1, weights), (2, weights * 0.5)]).collect()}
    for epoch, then in ((1, weights), (2, weights * 0.5)):
        p = network.forward(then, x)[-1][:, 0]  # equal scores count together
        area = sum(y[p == v].sum() * y[p >= v].mean() for v in np.unique(p)) / y.sum()
        assert abs(found[epoch] - area) < 1e-9
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_gradient_equals_differences():
    network = epochs.Perceptron((3, 4, 2, 1))
    rng = np.random.default_rng(0)
    x, y, scale = rng.normal(size=(7, 3)), np.array([0, 1, 1, 0, 1, 0, 0]), rng.random(7)
    weights = network.start(1) + 0.1
    got, _ = network.gradient(weights, x, y, scale, 0.8, 1.5)
    for k in range(0, len(weights), 3):
        step = np.zeros_like(weights)
        step[k] = 1e-6
        up, down = (network.gradient(weights + s, x, y, scale, 0.8, 1.5)[1] for s in (step, -step))
        assert abs((up - down) / 2e-6 - got[k]) < 1e-5


def test_evidence_decides_the_fallback(spark):
    """Seven days in a row, a stored row of two weeks, an older one, and a site with nothing but one old reading."""
    def day(k):
        return dt.date(2024, 3, 1) + dt.timedelta(k)

    seen = [(1, day(k)) for k in range(24, 31)] + [(2, day(k)) for k in (10, 17, 24, 30)] + [(3, day(30)), (4, day(1))]
    days = spark.createDataFrame(seen + [(1, day(30))], "site_id int, date date")
    stored = spark.createDataFrame([(1, day(23)), (2, day(17)), (2, day(16)), (3, day(15))], "site_id int, date date")
    newest = F.lit(day(30))
    got = {r["site_id"]: tuple(r)[1:] for r in scoring.evidence(days, stored, newest).collect()}
    assert got == {1: (7, 7, True, True), 2: (2, 13, False, True), 3: (1, 15, False, False), 4: (0, None, False, False)}
    live, kept = scoring.by_evidence(days, stored, days, newest)
    assert {r["site_id"] for r in live.collect()} == {1} and {r["site_id"] for r in kept.collect()} == {1, 2}
    assert scoring.evidence(days.where("false"), stored.where("false"), newest).count() == 0


def test_a_constant_model_does_not_fit(spark):
    rows = [(i % 2, 0.5, float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "target int, prob double, good double")
    assert df.select(model_queries._fits(df)).first()[0] is False
    assert df.select(model_queries._fits(df.withColumn("prob", F.col("good")))).first()[0] is True


def test_published_versions(spark, planted):
    """The newest pointer counts; a version without one is not seen; other features are an error."""
    place = work_path(spark, "published")
    small, large = (forest.fit_forest(planted, COLS, trees=n, depth=2) for n in (1, 3))
    sequence_model.publish_model(place, small, COLS, spark)
    last = sequence_model.publish_model(place, large, COLS, spark, note="x")
    sequence_model.save_model(f"{place}/versions/unfinished", small, COLS, spark)
    model, meta = sequence_model.load_published(place, spark, COLS)
    assert model.stages[-1].getNumTrees == 3 and meta == {"cols": COLS, "note": "x"} and last in spark.read.parquet(
        f"{place}/published").toPandas()["version"].tolist()
    with pytest.raises(ValueError):
        sequence_model.load_published(place, spark, COLS[::-1])
    sequence_model.publish_model(place, small, COLS[:2], spark)
    with pytest.raises(ValueError):
        sequence_model.load_published(place, spark)
