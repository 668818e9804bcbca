"""What the plans must not contain, and what must reach the scan."""

import pytest

import __spark_entry__ as entry
from skyloom.plans import all_queries

SLOW = {"s11_saved_scores", "m1_forest_scores", "m3_cv", "m5_attribution", "m5_additivity", "m6_sequence_scores", "m7_sequence_newest", "m9_fallback_scores",
        "m6_epoch_history", "m1_forest_probabilities", "m7_sequence_decisions", "m9_fallback_risks", "t1_stream_json",
        "t5_stream_risks", "t2_stream_upsert", "t3_stream_daily", "t4_stream_status", "t5_stream_archive", "t6_stream_drop_late"}


def plan(spark, sf, name):
    return entry.queries()[name](spark, sf)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries.QUERIES) - SLOW))
def test_no_pair_joins_and_no_python(spark, sf, name):
    text = plan(spark, sf, name)
    physical = text[text.index("== Physical Plan =="):]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in physical, bad


def test_flagship_reads_only_its_columns(spark, sf):
    text = plan(spark, sf, "m11_features")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert "props" not in text[text.index("== Physical Plan =="):]


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(spark, sf, "u2_union_years")
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in text
    years = plan(spark, sf, "s6_grid_years")
    assert "year" in years.split("PartitionFilters: [")[1].split("]")[0]


def test_daily_features_shuffle_once_per_key(spark, sf):
    """Cuts and carry by site and slot, days, then one exchange and sort for the whole window chain."""
    text = plan(spark, sf, "m11_features")
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning(site_id") <= 6
    windows = [line for line in physical.splitlines() if "Window [" in line]
    assert len(windows) >= 3


def test_split_leaves_the_rows_where_they_are(spark, sf):
    """One row per date goes to every task; the table itself is not dealt by date."""
    for name in ("w12_folds", "w13_split"):
        text = plan(spark, sf, name)
        physical = text[text.index("== Physical Plan =="):]
        assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
        assert "Exchange hashpartitioning(date" not in physical


def test_boxes_do_not_grow_the_plan(spark, sf):
    from skyloom.operators import series

    cells = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "l_shipdate AS valid_time", "l_quantity AS latitude", "l_tax AS longitude", "l_discount AS tcc")

    def size(n):
        found = series.grid_mean(cells, [(k, 4.0, 0.0, 1.0, 2.0) for k in range(n)])._jdf.queryExecution().toString()
        assert found[found.index("== Physical Plan =="):].count("FileScan") == 1
        return found.count("\n")

    assert size(500) == size(2)
