from __future__ import annotations

import re

import oracle
import pytest

import __spark_entry__ as entry
from tidemark import catalog

# The optional part has its own tests.
QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# Execution of rows in Python, and joins that pair everything with everything.
FORBIDDEN = [
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "CollectLimit",
]

# Windows over one frame that a query has reduced to a few rows.
SMALL_BY_COUNT = {"next_category_sales", "dedup_first_order", "session_event_stats"}


def _check_plan(key, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []
    # A window without partitions belongs to summaries and counted small inputs only.
    for line in plan.splitlines():
        if re.search(r"Window \[row_number|Window \[rank|Window \[la?e?[gd]", line):
            summary = "_range" in line or "_part" in line or "_summary" in line
            assert summary or key in SMALL_BY_COUNT, line


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    _check_plan(key, df)
    if key in ORACLES:
        problem, _ = oracle.compare(con, df, ORACLES[key])
        assert problem is None, problem
    else:
        df.count()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
