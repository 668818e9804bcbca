import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from skyloom.functions.numbers import clip, exact_text, finite, normalize, round_exact


def _values():
    rng = random.Random(7)
    close = [0.1545, 0.1555, 0.0005, 0.0625, 2.675, 1.005, 0.5, 1.5, 2.5, -0.04, -2.5, 0.0, 12.25, 12.35, -7.731343]
    return close + [rng.uniform(-50, 50) for _ in range(500)] + [k / 2000 for k in range(1, 800)]


def test_round_exact_is_python_round(spark):
    values = _values()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3, 4):
        for row in df.select("v", round_exact("v", digits).alias("r")).collect():
            assert row["r"] == round(row["v"], digits), (row["v"], digits)


def test_exact_text_rounds_ties_away(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "v double")
    for digits in (0, 1, 3):
        step = Decimal(1).scaleb(-digits)
        for row in df.select("v", exact_text("v", digits, ties="up").alias("t")).collect():
            v = row["v"]
            want = ("-" if v < 0 else "") + str(Decimal(abs(v)).quantize(step, rounding=ROUND_HALF_UP))
            assert row["t"] == want, v


def test_clip_and_normalize_keep_missing(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (23.0,), (99.0,)], "v double")
    rows = df.select(clip("v", 0.0, 46.0).alias("c"), normalize("v", 0, 46).alias("n")).collect()
    assert [tuple(r) for r in rows] == [(None, None), (0.0, 0.0), (23.0, 0.5), (46.0, 1.0)]


def test_finite(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,), (math.nan,), (None,), (1.0,)], "v double")
    assert [r["f"] for r in df.select(finite("v").alias("f")).collect()] == [None, None, None, None, 1.0]
    assert df.select(F.count(finite("v")).alias("n")).first()["n"] == 1
