"""Registered queries: values against SQL, and the shape of their plans."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.plans import oracle, registry
from tools.compare import TABLES, compare

# the fits of the model queries take minutes; tools/compare.py runs them too
CHECKED = [name for name in oracle.registered() if name not in registry.MODELS]
PLANNED = [*registry.ANALYTICS, "dq_report", "keep_first", "sentiment_score", "sentiment_backfill", "demand_features"]
# windows without PARTITION BY that are bounded: one row per range partition,
# or the rows of a top-k report
BOUNDED = re.compile(r"\], \[(_part|score)#\d+ (ASC|DESC) NULLS (FIRST|LAST)\]$")


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


def test_contract():
    """Every query outside the optional subpackage has SQL."""
    assert set(registry.registered()) == set(oracle.registered())
    assert set(registry.registered()) <= set(entry.queries()) and set(oracle.registered()) <= set(entry.oracle_sql())


def test_no_query_cuts_its_input():
    text = Path(registry.__file__).read_text()
    assert not re.search(r"%\s*\d|substring\(|idx\s*<|\.limit\(|\.sample\(", text)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_values(spark, con, small, name):
    note, _, good = compare(spark, con, small, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good or note.startswith("DIFFER 0 / 0 rows"), note  # no row on either side is right too


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_cross_join_or_whole_table_window(spark, small, name):
    query = entry.queries()[name](spark, small)._jdf.queryExecution()
    physical = query.executedPlan().toString()
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
    for window in re.findall(r"Window \[.*", query.optimizedPlan().toString()):
        partitioned = re.search(r"\], \[[^\]]+\], \[[^\]]+\]$", window) or not re.search(r" (ASC|DESC) NULLS \w+\]$", window)
        assert partitioned or BOUNDED.search(window), window
