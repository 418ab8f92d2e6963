"""Named queries against their SQL. All of them with TIEOUT_ALL_QUERIES=1, else the quick ones."""

import os
import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract
from check_oracles import compare
from tieout.plans.oracles import ORACLES
from tieout.plans.registry import QUERIES

ON_AUDIT = [name for name, sql in ORACLES.items() if re.search(r"\baudit AS \(", sql)]
QUICK = [name for name in QUERIES if name not in ON_AUDIT] + ["audit_assembly", "run_summary"]
NAMES = list(QUERIES) if os.environ.get("TIEOUT_ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, folder, name):
    problems = compare(spark, con, folder, name)
    assert [p for p in problems if not p.startswith("note")] == []


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 15


@pytest.mark.parametrize("name", ["reconciliation_result", "render_case", "check_labels", "facets"])
def test_no_pairwise_joins(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def test_only_needed_columns_are_read(spark, folder):
    plan = QUERIES["category_counts"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert read == {"o_orderkey:bigint,o_totalprice:double"}
