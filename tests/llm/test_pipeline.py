"""The pipeline stage by stage against brute force, and the registered text queries against their SQL twins."""

from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import decontamination, quality_rules
from skyloom.llm.queries import ORACLES, QUERIES
from skyloom.session import durable


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = Counter(result.fetchall())
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, sf), "stage")
        after[name] = {r["doc_id"]: r for r in docs.collect()}
        assert len(after[name]) == docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    rules, langs, join, clean, mix = after.values()
    mask = quality_rules.policy_mask(quality_rules.PRODUCTION)
    ledger = quality_rules.ledger(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert set(rules) == {r["doc_id"] for r in ledger if not r["fail_bits"] & mask}
    assert set(langs) == set(rules)  # every document with fifty words has letters
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            for i, w in ((i, r["text"].encode().split()) for i, r in langs.items())}
    for i in langs:  # whoever left has a near-duplicate, and nobody who stayed has one with a lower id left out
        twins = [j for j in langs if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        assert i in join or twins
        assert not (i in join and any(j in join for j in twins))
    items = [decontamination.normal(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for i, r in join.items():
        plain = decontamination.normal(r["text"])
        if any(item in plain for item in items):
            assert i not in clean
    assert len(clean) >= 0.9 * len(join)
    assert set(mix) <= set(clean) and all(0 < r["taken"] <= 3 * r["size"] for r in mix.values())


def test_pipeline_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, sf), "stage")
    assert docs.count() == 0


def test_stages_bound_the_bytes_of_a_batch(spark):
    """2,000 texts of 10 KB in one partition went to Python as one batch of 20 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [int(batch["text"].str.len().sum())]})

    try:
        docs = spark.createDataFrame([(1, "a b", "s", "en")], "doc_id long, text string, source string, lang string")
        corpus_pipeline.quality(spark, docs, "")
        found = [r["n"] for r in texts.mapInPandas(sizes, "n long").collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(found) == 20_000_000 and max(found) <= corpus_pipeline.BATCH_BYTES + 10_000
