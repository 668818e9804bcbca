"""Evaluation of scores against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.operators.ranking import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def _ratio(top: Column, bottom: Column, default: float = 0.0) -> Column:
    return F.coalesce(top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0)), F.lit(default))


# ---------------------------------------------------------------- counts
def class_share(df: DataFrame, col: str = "target") -> DataFrame:
    """Share of each class; the second step sees one row per class."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("n") / total)


def event_rate(df: DataFrame, flags=K.EVENT_FLAGS) -> DataFrame:
    """A10: totals per flag and the rate of extreme days."""
    return df.agg(
        F.count(F.lit(1)).alias("days"),
        *[F.sum(f).alias(f"n_{f}") for f in flags],
        F.avg("event_extreme").alias("event_rate"),
    )


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of each column, one row per column.

    Exact quartiles interpolate linearly between order statistics found with running totals, so no
    task holds a column's values. ``exact=False`` uses mergeable sketches in the same single pass.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("e")).select("e.*").filter(F.col("value").isNotNull())
    names = [f"q{int(q * 100)}" for q in QUARTILES]
    if not exact:
        sketch = F.percentile_approx("value", list(QUARTILES), 10000)
        return long.groupBy("column").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max"), sketch.alias("_q"),
        ).select("column", "count", "mean", "std", "min", *[F.element_at("_q", i + 1).alias(n) for i, n in enumerate(names)], "max")
    # the table is read once; distinct values with their counts give the ranks and the moments
    totals = running_totals(long, "value", {"n": F.count(F.lit(1))}, group="column")
    means = totals.groupBy(F.col("column").alias("_of")).agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))

    def statistic(q):
        at = (F.col("all_n") - 1) * F.lit(q)
        low = F.min(F.when(F.col("cum_n") > F.floor(at), F.col("value")))
        high = F.min(F.when(F.col("cum_n") > F.ceil(at), F.col("value")))
        part = F.max(at - F.floor(at))
        return low + (high - low) * part

    away = F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2.0)))
    return totals.join(F.broadcast(means), F.col("column") == F.col("_of")).groupBy("column").agg(
        F.sum("n").alias("count"), F.first("mean").alias("mean"),
        F.sqrt(away / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"), F.min("value").alias("min"),
        *[statistic(q).alias(n) for q, n in zip(QUARTILES, names)], F.max("value").alias("max"))


# ---------------------------------------------------------------- thresholded metrics
def confusion(df: DataFrame, threshold: float, prob: str = "prob", label: str = "label") -> DataFrame:
    """All four cells, also the empty ones."""
    predicted = (F.col(prob) >= threshold).cast("int")
    cells = df.agg(*[
        F.count_if((F.col(label) == y) & (predicted == p)).alias(f"c{y}{p}") for y in (0, 1) for p in (0, 1)
    ])
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(f"c{y}{p}").alias("n"))
        for y in (0, 1) for p in (0, 1)
    ])))


def class_report(df: DataFrame, threshold: float, prob: str = "prob", label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support per class; empty denominators give 0."""
    cells = confusion(df, threshold, prob, label).agg(*[
        F.sum(F.when((F.col("label") == y) & (F.col("predicted") == p), F.col("n"))).alias(f"c{y}{p}")
        for y in (0, 1) for p in (0, 1)
    ])

    def row(y):
        hit, missed, wrong = F.col(f"c{y}{y}"), F.col(f"c{y}{1 - y}"), F.col(f"c{1 - y}{y}")
        return F.struct(
            F.lit(y).alias("label"), _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(hit * 2, hit * 2 + missed + wrong).alias("f1"), (hit + missed).alias("support"),
        )

    return cells.select(F.inline(F.array(row(0), row(1))))


def fbeta_of(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b = F.lit(float(beta) ** 2)
    return _ratio((F.lit(1.0) + b) * tp, (F.lit(1.0) + b) * tp + b * fn + fp)


def _grouped(df: DataFrame, by: str | None, *aggregates: Column) -> DataFrame:
    return df.groupBy(by).agg(*aggregates) if by else df.agg(*aggregates)


def fbeta(
    df: DataFrame, beta: float = 1.0, threshold: float = 0.5, prob: str = "prob", label: str = "label",
    by: str | None = None,
) -> DataFrame:
    """A16, for the table or per value of ``by`` (fold, model)."""
    hit, real = F.col(prob) >= threshold, F.col(label) == 1
    return _grouped(
        df, by, F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"),
    ).withColumn("fbeta", fbeta_of(F.col("tp"), F.col("fp"), F.col("fn"), beta))


def threshold_sweep(
    df: DataFrame, thresholds=K.THRESHOLDS, beta: float = 1.0, prob: str = "prob", label: str = "label",
) -> DataFrame:
    """F-beta at every threshold from one pass over the predictions.

    Each prediction counts once, at the number of thresholds it reaches; running sums over those
    few counts give the hits of every threshold. The table is never paired with the thresholds.
    """
    thresholds = sorted(float(t) for t in thresholds)
    reached = _reached(F.col(prob), thresholds)
    counts = df.groupBy(reached.alias("k")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    # at most len(thresholds) + 1 rows from here on: fold them into one row of two maps
    folded = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("k", "pos"))).alias("pos"),
        F.map_from_entries(F.collect_list(F.struct("k", "neg"))).alias("neg"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("all_pos"),
    )

    def at_least(counted, k):
        return F.aggregate(
            F.map_entries(counted), F.lit(0).cast("long"),
            lambda total, e: total + F.when(e["key"] >= k, e["value"]).otherwise(F.lit(0)))

    rows = folded.select(
        "pos", "neg", "all_pos",
        F.posexplode(F.lit(thresholds)).alias("i", "threshold"),
    ).select(
        "threshold",
        at_least(F.col("pos"), F.col("i") + 1).alias("tp"),
        at_least(F.col("neg"), F.col("i") + 1).alias("fp"), "all_pos",
    )
    fn = F.col("all_pos") - F.col("tp")
    return rows.select("threshold", "tp", "fp", fn.alias("fn"), fbeta_of(F.col("tp"), F.col("fp"), fn, beta).alias("fbeta"))


def _reached(value: Column, thresholds: list[float]) -> Column:
    """How many of the ascending thresholds the value reaches (``>=``)."""
    table = F.lit(thresholds)
    strides = [1 << i for i in reversed(range(len(thresholds).bit_length()))]

    def advance(at, stride):
        ahead = at + stride
        return F.when(F.coalesce(F.get(table, ahead - 1) <= value, F.lit(False)), ahead).otherwise(at)

    return F.aggregate(F.lit(strides), F.lit(0), advance)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """K6: the lowest threshold with the highest F-beta, or the default if all are 0."""
    best = sweep.agg(F.max_by(F.struct("threshold", "fbeta"), F.struct("fbeta", -F.col("threshold"))).alias("b"))
    return best.select(
        F.when(F.col("b.fbeta") > 0, F.col("b.threshold")).otherwise(F.lit(K.DEFAULT_THRESHOLD)).alias("threshold"),
        F.greatest(F.col("b.fbeta"), F.lit(0.0)).alias("fbeta"),
    )


def tuned_fbeta(validation: DataFrame, test: DataFrame, beta: float = 1.0, prob: str = "prob", label: str = "label") -> DataFrame:
    """M8: F-beta on ``test`` at the threshold chosen on ``validation``."""
    chosen = best_threshold(threshold_sweep(validation, beta=beta, prob=prob, label=label))
    limit = chosen.select("threshold").scalar()
    hit, real = F.col(prob) >= F.col("_t"), F.col(label) == 1
    return test.withColumn("_t", limit).agg(
        F.max("_t").alias("threshold"), F.count_if(hit & real).alias("tp"),
        F.count_if(hit & ~real).alias("fp"), F.count_if(~hit & real).alias("fn"),
    ).withColumn("fbeta", fbeta_of(F.col("tp"), F.col("fp"), F.col("fn"), beta))


# ---------------------------------------------------------------- ranked metrics
def _by_score(df: DataFrame, prob: str, label: str, by: str | None, descending: bool) -> DataFrame:
    scored = df.filter(F.col(prob).isNotNull() & F.col(label).isNotNull())
    return running_totals(
        scored, prob,
        {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)},
        group=by, descending=descending,
    )


def roc_auc(
    df: DataFrame, prob: str = "prob", label: str = "label", by: str | None = None,
) -> DataFrame:
    """Exact rank statistic with ties counted half; 0.5 when a class is absent."""
    below = F.col("cum_neg") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return _grouped(_by_score(df, prob, label, by, False), by, _ratio(wins, pairs, 0.5).alias("roc_auc"))


def average_precision(
    df: DataFrame, prob: str = "prob", label: str = "label", by: str | None = None,
) -> DataFrame:
    """Step-form area under precision-recall; 0 when a class is absent."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    area = F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos").cast("double"), F.lit(0.0))
    return _grouped(
        _by_score(df, prob, label, by, True), by,
        F.when(F.sum("neg") > 0, F.coalesce(area, F.lit(0.0))).otherwise(F.lit(0.0)).alias("average_precision"))


def focal_loss(
    df: DataFrame, alpha: float = K.FOCAL_ALPHA, gamma: float = K.FOCAL_GAMMA, prob: str = "prob", label: str = "label",
) -> DataFrame:
    """Mean focal loss; logarithms are bounded at -100."""
    p, y = F.col(prob).cast("double"), F.col(label) == 1
    p_true = F.when(y, p).otherwise(F.lit(1.0) - p)
    log = F.when(p_true > 0, F.greatest(F.log(p_true), F.lit(-100.0))).otherwise(F.lit(-100.0))
    weight = F.when(y, F.lit(alpha)).otherwise(F.lit(1.0 - alpha))
    return df.agg(F.avg(weight * F.pow(F.lit(1.0) - p_true, F.lit(gamma)) * -log).alias("focal_loss"))


# ---------------------------------------------------------------- metric tables
def early_stop(history: DataFrame, metric: str = "auc_pr", patience: int = K.PATIENCE, run: str = "run", epoch: str = "epoch") -> DataFrame:
    """Best value so far, rows since it was set, and whether training has stopped, per run.

    A run's history has one row per epoch, which bounds the window.
    """
    w = Window.partitionBy(run).orderBy(epoch)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    before = F.max(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ranked = history.withColumns({
        "best": F.greatest(F.max(metric).over(so_far), F.lit(0.0)),
        "_row": F.row_number().over(w),
        "_new": F.col(metric) > F.coalesce(F.greatest(before, F.lit(0.0)), F.lit(0.0)),
    })
    marked = ranked.withColumn("_at", F.max(F.when(F.col("_new"), F.col("_row"))).over(so_far))
    waited = marked.withColumn("since_best", F.col("_row") - F.coalesce(F.col("_at"), F.lit(0)))
    return waited.withColumn(
        "stopped", F.max((F.col("since_best") >= patience).cast("int")).over(so_far)
    ).drop("_row", "_new", "_at")


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean F1 and AUC over folds."""
    return folds.agg(F.avg("f1").alias("mean_f1"), F.avg("auc").alias("mean_auc"))


def compare_models(metrics: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """One row per metric, one column per model; each input is a one-row metrics table."""
    long = None
    for model, row in metrics.items():
        part = row.select(F.lit(model).alias("model"), F.inline(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names if n in row.columns
        ])))
        long = part if long is None else long.unionByName(part)
    return long.groupBy("metric").pivot("model", list(metrics)).agg(F.first("value"))


def attribution_summary(df: DataFrame, top: int = K.TOP_FEATURES) -> DataFrame:
    """Mean absolute attribution per feature, highest first."""
    return (
        df.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature").limit(top)
    )
