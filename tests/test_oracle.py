"""Every registered query against its DuckDB oracle (row count, columns, value hash) on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

from starhouse.plans.queries import registry  # noqa: E402

NAMES = list(registry())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    from oracle_compare import compare
    assert compare(spark, SF_SMALL, [name], verbose=True)[name] is True


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 6000 and df.columns[0] == "sales_key"


@pytest.mark.parametrize("name", ["audit_fact_faulty", "audit_dim_faulty"])
def test_faulty_audit_finds_every_kind(spark, name):
    found = {}
    for r in registry()[name](spark, SF_SMALL).collect():
        found[r.check_name] = max(found.get(r.check_name, 0), r.violations)
    assert found and all(found.values())


@pytest.mark.parametrize("name, rules", [("quality_split_items", 7), ("quality_split_orders", 4)])
def test_faulty_rows_break_every_rule(spark, name, rules):
    rows = registry()[name](spark, SF_SMALL).select("failed_rules", "accepted").distinct().collect()
    assert len({x for r in rows for x in r.failed_rules.split(",") if x}) == rules
    assert all(r.accepted == (r.failed_rules == "") for r in rows) and any("," in r.failed_rules for r in rows)
