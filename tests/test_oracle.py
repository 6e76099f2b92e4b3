"""Every registered key against its DuckDB oracle on the smallest fixture (sf0.001)."""

import pytest

import __spark_entry__ as entry
from souk.oracle import compare
from souk.plans.catalog import QUERIES

from .conftest import SMALL

KEYS = sorted(QUERIES)
ORACLE = {k: sql for k, sql in entry.oracle_sql().items() if k in QUERIES}


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(KEYS) and set(KEYS) <= set(entry.queries())


def test_inventory_size():
    # SURVEY section 2.1-2.10 lists 134 operators
    assert len(KEYS) == 134


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SMALL)
    problems = compare.diff(df, duck, ORACLE[key])
    assert not problems, "\n".join(problems)


def test_check_schema_ok(spark):
    rows = entry.queries()["check_schema"](spark, SMALL).collect()
    assert len(rows) == 34 + 48 and all(r["ok"] for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns
