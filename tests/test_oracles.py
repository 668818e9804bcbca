"""Every registered query against its SQL twin, and invariants of those without one."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from skyloom.plans import all_queries
from tools import check


@pytest.fixture(scope="module")
def con(sf):
    return check.oracle_connection(sf)


@pytest.mark.parametrize("name", sorted(all_queries.ORACLES))
def test_matches_sql(spark, sf, con, name):
    problem, rows, _ = check.compare(spark, con, sf, name)
    assert not problem
    assert rows > 0


def test_entry_schema(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 47
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_everything_else_works_without_the_text_folders(tmp_path):
    """A copy without the text subpackage and its tests: all other queries are there and the tests collect."""
    here = Path(entry.__file__).parent
    gone = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache", ".hypothesis")
    for pipeline_stays in (False, True):
        copy = tmp_path / f"copy{pipeline_stays}"
        shutil.copytree(here, copy, ignore=gone)
        if pipeline_stays:
            shutil.copy(here / "corpus_pipeline.py", copy)
        code = "import __spark_entry__ as e; print(sorted(e.queries()) + sorted(e.oracle_sql()))"
        found = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
        assert found.stdout.strip() == str(sorted(all_queries.QUERIES) + sorted(all_queries.ORACLES))
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=copy, capture_output=True)
    assert done.returncode == 0


@pytest.mark.parametrize("name", ["m6_sequence_scores"])
def test_probabilities(spark, sf, name):
    rows = entry.queries()[name](spark, sf).collect()
    assert rows
    assert all(0.0 <= r["prob"] <= 1.0 for r in rows)


def test_cross_validation(spark, sf):
    rows = entry.queries()["m3_cv"](spark, sf).collect()
    assert sorted(r["fold"] for r in rows) == [1, 2, 3, 4, 5]
    assert all(0 <= r[c] <= 1 for r in rows for c in ("f1", "auc", "auc_pr"))
