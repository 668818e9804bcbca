"""Queries over scores, labels and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.ml import split
from skyloom.operators import evaluate, history
from skyloom.plans import bridge as B
from skyloom.plans.registry import query, rounded
from skyloom.session import work_path
from skyloom.sources import tables

_DESCRIBED = ["amount", "peak"]


@query("a11_describe", f"""WITH {B.SHIP_DAYS}, long AS (
  SELECT 'amount' AS "column", amount AS value FROM ship_days UNION ALL SELECT 'peak', peak FROM ship_days)
SELECT "column", CAST(count(*) AS BIGINT) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max FROM long GROUP BY 1""")
def a11_describe(spark, sf):
    return rounded(evaluate.describe(B.ship_days(spark, sf), _DESCRIBED))


_CELLS = f"""WITH {B.SCORED}, cells AS (SELECT label, CASE WHEN prob >= 0.38 THEN 1 ELSE 0 END AS predicted FROM scored)"""


@query("a14_confusion", f"""{_CELLS} SELECT a.label, b.predicted, CAST(count(c.label) AS BIGINT) AS n
FROM (VALUES (0), (1)) a(label) CROSS JOIN (VALUES (0), (1)) b(predicted)
LEFT JOIN cells c ON c.label = a.label AND c.predicted = b.predicted GROUP BY 1, 2""")
def a14_confusion(spark, sf):
    return evaluate.confusion(B.scored(spark, sf), 0.38)


@query("a15_class_report", f"""{_CELLS}, counted AS (SELECT y.label, sum(CASE WHEN c.label = y.label AND predicted = y.label THEN 1e0 ELSE 0 END) AS hit,
    sum(CASE WHEN predicted = y.label THEN 1e0 ELSE 0 END) AS called, sum(CASE WHEN c.label = y.label THEN 1e0 ELSE 0 END) AS has
  FROM cells c CROSS JOIN (VALUES (0), (1)) y(label) GROUP BY 1)
SELECT label, round(coalesce(hit / nullif(called, 0), 0e0), 6) AS precision, round(coalesce(hit / nullif(has, 0), 0e0), 6) AS recall,
  round(coalesce(2 * hit / nullif(called + has, 0), 0e0), 6) AS f1, CAST(has AS BIGINT) AS support FROM counted""")
def a15_class_report(spark, sf):
    return rounded(evaluate.class_report(B.scored(spark, sf), 0.38))


@query("a16_fbeta", f"""WITH {B.SCORED}, c AS (SELECT CAST(count_if(prob >= 0.5 AND label = 1) AS BIGINT) AS tp,
  CAST(count_if(prob >= 0.5 AND label = 0) AS BIGINT) AS fp, CAST(count_if(prob < 0.5 AND label = 1) AS BIGINT) AS fn FROM scored)
SELECT *, round(5e0 * tp / nullif(5e0 * tp + 4e0 * fn + fp, 0), 6) AS fbeta FROM c""")
def a16_fbeta(spark, sf):
    return rounded(evaluate.fbeta(B.scored(spark, sf), beta=2.0, threshold=0.5))


@query("a17_roc_auc", f"""WITH {B.SCORED}, ranked AS (
  SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2e0 AS r FROM scored),
t AS (SELECT sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS rs, CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n FROM ranked)
SELECT round((rs - p * (p + 1) / 2e0) / (p * n), 6) AS roc_auc FROM t""")
def a17_roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(B.scored(spark, sf)))


@query("a18_avg_precision", f"""WITH {B.SCORED}, g AS (SELECT prob, CAST(sum(label) AS DOUBLE) AS tp, CAST(count(*) AS DOUBLE) AS n FROM scored GROUP BY 1),
c AS (SELECT tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn, sum(tp) OVER () AS p FROM g WINDOW w AS (ORDER BY prob DESC))
SELECT round(sum(tp / p * ctp / cn), 6) AS average_precision FROM c""")
def a18_avg_precision(spark, sf):
    return rounded(evaluate.average_precision(B.scored(spark, sf)))


@query("a21_focal_loss", f"""WITH {B.SCORED}, t AS (SELECT label, CASE WHEN label = 1 THEN prob ELSE 1 - prob END AS pt FROM scored)
SELECT round(avg((CASE WHEN label = 1 THEN 0.8e0 ELSE 1e0 - 0.8e0 END) * pow(1 - pt, 1.5e0) * -greatest(ln(pt), -100e0)), 6) AS focal_loss FROM t""")
def a21_focal_loss(spark, sf):
    return rounded(evaluate.focal_loss(B.scored(spark, sf)))


def _sweep_sql(beta: float, where: str = "") -> str:
    b = beta * beta
    return f"""grid AS (SELECT (5 + i) / 100e0 AS threshold FROM range(0, 85) r(i)),
counts AS (SELECT threshold, CAST(count_if(prob >= threshold AND label = 1) AS BIGINT) AS tp, CAST(count_if(prob >= threshold AND label = 0) AS BIGINT) AS fp,
  CAST(count_if(prob < threshold AND label = 1) AS BIGINT) AS fn FROM scored CROSS JOIN grid {where} GROUP BY 1),
sweep AS (SELECT *, coalesce({1 + b}e0 * tp / nullif({1 + b}e0 * tp + {b}e0 * fn + fp, 0), 0e0) AS fbeta FROM counts)"""


@query("j6_threshold_sweep", f"WITH {B.SCORED}, {_sweep_sql(1.0)} SELECT threshold, tp, fp, fn, round(fbeta, 6) AS fbeta FROM sweep")
def j6_threshold_sweep(spark, sf):
    return rounded(evaluate.threshold_sweep(B.scored(spark, sf)))


@query("k6_best_threshold", f"WITH {B.SCORED}, {_sweep_sql(2.0)} SELECT threshold, round(fbeta, 6) AS fbeta FROM sweep ORDER BY sweep.fbeta DESC, threshold LIMIT 1")
def k6_best_threshold(spark, sf):
    return rounded(evaluate.best_threshold(evaluate.threshold_sweep(B.scored(spark, sf), beta=2.0)))


@query("m8_tuned_fbeta", f"""WITH {B.SCORED}, {_sweep_sql(1.0, "WHERE date <= DATE '2024-01-20'")},
best AS (SELECT threshold FROM sweep ORDER BY fbeta DESC, threshold LIMIT 1),
c AS (SELECT threshold, CAST(count_if(prob >= threshold AND label = 1) AS BIGINT) AS tp, CAST(count_if(prob >= threshold AND label = 0) AS BIGINT) AS fp,
  CAST(count_if(prob < threshold AND label = 1) AS BIGINT) AS fn FROM scored, best WHERE date > DATE '2024-01-20' GROUP BY 1)
SELECT *, round(2e0 * tp / nullif(2e0 * tp + fn + fp, 0), 6) AS fbeta FROM c""")
def m8_tuned_fbeta(spark, sf):
    rows = B.scored(spark, sf)
    return rounded(evaluate.tuned_fbeta(
        rows.filter(F.col("date") <= "2024-01-20"), rows.filter(F.col("date") > "2024-01-20")))


# ---------------------------------------------------------------- folds and splits
_PLACED = f"""WITH {B.SHIP_DAYS}, placed AS (
  SELECT *, CAST(rank() OVER (ORDER BY date) - 1 AS BIGINT) AS position, CAST(count(*) OVER () AS BIGINT) AS total FROM ship_days)"""
_FOLDED = f"""{_PLACED}, sized AS (SELECT *, total // 6 AS size FROM placed),
folded AS (SELECT *, CAST(CASE WHEN position < total - 5 * size THEN 0 ELSE (position - (total - 5 * size)) // size + 1 END AS INTEGER) AS fold FROM sized)"""


@query("w12_folds", f"""{_FOLDED},
per_site AS (SELECT site_id, date, row_number() OVER (PARTITION BY site_id ORDER BY date) - 1 AS p, count(*) OVER (PARTITION BY site_id) AS n FROM ship_days)
SELECT f.site_id, f.date, f.position, f.fold,
  CAST(CASE WHEN p < n - 5 * (n // 6) THEN 0 ELSE (p - (n - 5 * (n // 6))) // nullif(n // 6, 0) + 1 END AS INTEGER) AS site_fold
FROM folded f JOIN per_site s ON s.site_id = f.site_id AND s.date = f.date""")
def w12_folds(spark, sf):
    """Folds over the whole table by date, and over each site's own series."""
    whole = split.ts_folds(B.ship_days(spark, sf)).select(
        "site_id", "date", F.col("position").alias("place"), F.col("fold").alias("table_fold"))
    return split.ts_folds(whole, site="site_id").select(
        "site_id", "date", F.col("place").alias("position"), F.col("table_fold").alias("fold"),
        F.col("fold").alias("site_fold"))


@query("j7_fold_membership", f"""{_FOLDED}, m AS (
  SELECT site_id, i AS in_fold, CASE WHEN fold = i THEN 'test' ELSE 'train' END AS role
  FROM folded JOIN range(1, 6) r(i) ON fold <= i)
SELECT CAST(in_fold AS INTEGER) AS in_fold, role, site_id, CAST(count(*) AS BIGINT) AS n FROM m GROUP BY 1, 2, 3""")
def j7_fold_membership(spark, sf):
    members = split.fold_membership(split.ts_folds(B.ship_days(spark, sf)))
    return members.groupBy("in_fold", "role", "site_id").agg(F.count(F.lit(1)).alias("n"))


@query("w13_split", f"""{_PLACED}, dated AS (SELECT *, dense_rank() OVER (ORDER BY date) - 1 AS day FROM placed),
ends AS (SELECT count(DISTINCT date) AS train_days FROM placed WHERE position < floor(total * 0.7e0))
SELECT site_id, date, CASE WHEN position < floor(total * 0.7e0) THEN 'train'
  WHEN position >= floor(total * (0.7e0 + 0.1e0)) THEN 'test' WHEN day < train_days + 14 THEN 'gap' ELSE 'val' END AS split
FROM dated, ends""")
def w13_split(spark, sf):
    return split.temporal_split(B.ship_days(spark, sf)).select("site_id", "date", "split")


@query("m2_class_weights", f"""WITH {B.SHIP_DAYS} SELECT site_id, date, target,
  round(count(*) OVER () / (2e0 * count(*) OVER (PARTITION BY target)), 6) AS weight FROM ship_days""")
def m2_class_weights(spark, sf):
    return rounded(split.class_weights(B.ship_days(spark, sf)).select("site_id", "date", "target", "weight"))


@query("w16_early_stop", """WITH history AS (
  SELECT user_id AS run, CAST(ts AS DATE) AS epoch, round(avg(value / (value + 40e0)), 9) AS auc_pr FROM events GROUP BY 1, 2),
b AS (SELECT *, max(auc_pr) OVER w AS best, row_number() OVER (PARTITION BY run ORDER BY epoch) AS rn,
  coalesce(max(auc_pr) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM history WINDOW w AS (PARTITION BY run ORDER BY epoch ROWS UNBOUNDED PRECEDING)),
m AS (SELECT *, max(CASE WHEN auc_pr > before THEN rn END) OVER (PARTITION BY run ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS mark FROM b),
s AS (SELECT *, rn - coalesce(mark, 0) AS since FROM m)
SELECT run, epoch, auc_pr, best, CAST(since AS INTEGER) AS since_best,
  CAST(max(CASE WHEN since >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS INTEGER) AS stopped FROM s""")
def w16_early_stop(spark, sf):
    """A metric history per run: each site's mean score per day."""
    v = F.col("value")
    history = B.table(spark, sf, "events").groupBy(F.col("user_id").alias("run"), F.to_date("ts").alias("epoch")).agg(
        F.round(F.avg(v / (v + 40.0)), 9).alias("auc_pr"))
    return evaluate.early_stop(history, patience=5)


@query("m13_compare", f"""WITH {B.SCORED}, cut AS (SELECT * FROM scored),
f AS (SELECT 0.5e0 AS t, * FROM cut UNION ALL SELECT 0.2e0, * FROM cut),
c AS (SELECT t, CAST(count_if(prob >= t AND label = 1) AS DOUBLE) AS tp, CAST(count_if(prob >= t AND label = 0) AS DOUBLE) AS fp,
  CAST(count_if(prob < t AND label = 1) AS DOUBLE) AS fn FROM f GROUP BY 1),
long AS (SELECT t, 'tp' AS metric, tp AS v FROM c UNION ALL SELECT t, 'fp', fp FROM c UNION ALL SELECT t, 'fn', fn FROM c
  UNION ALL SELECT t, 'fbeta', round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) FROM c)
SELECT metric, max(CASE WHEN t > 0.3 THEN v END) AS strict, max(CASE WHEN t < 0.3 THEN v END) AS loose FROM long GROUP BY 1""")
def m13_compare(spark, sf):
    rows = B.scored(spark, sf)
    return rounded(evaluate.compare_models(
        {"strict": evaluate.fbeta(rows, threshold=0.5), "loose": evaluate.fbeta(rows, threshold=0.2)},
        ["tp", "fp", "fn", "fbeta"]))


@query("p16_align", """SELECT event_id, value, 0e0 AS absent, CAST(user_id AS DOUBLE) AS user_id,
  'value,user_id' AS present, 'absent' AS missing FROM events""")
def p16_align(spark, sf):
    """The ordered model input, an absent feature filled with 0, and which columns were there."""
    events = B.table(spark, sf, "events")
    present, missing = split.require_columns(events, ["value", "absent", "user_id"], strict=False)
    aligned = split.align_columns(events, ["value", "absent", "user_id"], keep=["event_id"])
    return aligned.withColumns({"present": F.lit(",".join(present)), "missing": F.lit(",".join(missing))})


@query("s10_metrics_record", """WITH folds AS (SELECT CAST(user_id % 5 + 1 AS INTEGER) AS fold,
    round(avg(value / (value + 40e0)), 4) AS f1, round(avg(1e0 / (1e0 + value)), 4) AS auc FROM events GROUP BY 1)
SELECT 'forest' AS model, round((SELECT avg(f1) FROM folds), 6) AS mean_f1, round((SELECT avg(auc) FROM folds), 6) AS mean_auc,
  fold, f1, auc, (SELECT count(*) FROM events) AS n_samples FROM folds""")
def s10_metrics_record(spark, sf):
    """A nested metrics record written as JSON, read back and taken apart."""
    events = B.table(spark, sf, "events")
    v = F.col("value")
    folds = events.groupBy((F.col("user_id") % 5 + 1).cast("int").alias("fold")).agg(
        F.round(F.avg(v / (v + 40.0)), 4).alias("f1"), F.round(F.avg(F.lit(1.0) / (v + 1.0)), 4).alias("auc"))
    top = events.groupBy(F.col("event_type").alias("feature")).agg(F.avg("value").alias("importance"))
    summary = events.agg(
        F.lit(39).alias("n_features"), F.count(F.lit(1)).alias("n_samples"), F.avg((v > 50).cast("int")).alias("event_rate"))
    path = work_path(spark, "metrics")
    tables.write_metrics(tables.metrics_record(folds, top, summary, "forest"), path)
    record = tables.read_metrics(spark, path)
    return rounded(record.select("model", "mean_f1", "mean_auc", F.inline("folds"), "n_samples").select(
        "model", "mean_f1", "mean_auc", "fold", "f1", "auc", F.col("n_samples").cast("long").alias("n_samples")))


@query("u2_union_drift", """SELECT event_id, ts, CASE WHEN event_type <> 'view' THEN value END AS value,
  CASE WHEN event_type <> 'purchase' THEN user_id END AS user_id FROM events""")
def u2_union_drift(spark, sf):
    """Files whose columns drifted, one per event type: one lacks the value, one the user."""
    events = B.table(spark, sf, "events")
    views, purchases = F.col("event_type") == "view", F.col("event_type") == "purchase"
    return tables.union_all([
        events.where(~views & ~purchases).select("event_id", "ts", "value", "user_id"),
        events.where(views).select("user_id", "event_id", "ts"), events.where(purchases).select("ts", "value", "event_id")])


@query("k1_in_order", "SELECT event_id, user_id, ts FROM events")
def k1_in_order(spark, sf):
    """K1: a range-partitioned sort by site and time."""
    return history.in_order(B.table(spark, sf, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id")
