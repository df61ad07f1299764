"""Registered queries against DuckDB, and the numbers known for the larger tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, duck
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf, name):
    assert name in oracle_sql()
    assert compare(spark, con, name, sf) == ""


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["parent", "child", "call_count"]
    assert entry(spark).count() > 0


def test_known_counts(spark):
    rows = queries()["all_links"](spark, "/root/testdata/sf0.01").collect()
    kinds = {k: [r.links for r in rows if r.kind == k] for k in ("shared", "parent", "peer")}
    assert {k: (len(v), sum(v)) for k, v in kinds.items()} == {
        "shared": (606, 6432),
        "parent": (1241, 20288),
        "peer": (623, 7589),
    }
    edges = queries()["dependencies"](spark, "/root/testdata/sf0.01").collect()
    assert (len(edges), sum(r.call_count for r in edges)) == (1864, 34309)


def test_decode_tags_passes_values_through_json(spark, sf):
    plan = queries()["decode_tags"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("value:double" in line.split("ReadSchema")[1] for line in scans)
