"""Every written layer table against its oracle CTE (sf0.001): all 9 raw inputs after a CSV
round trip, and all 36 cleaned / reject tables of both cleaning generations."""

import pytest

from souk.oracle import compare
from souk.oracle.ctes import assemble
from souk.plans.warehouse import warehouse
from souk.sources.schemas import TABLES

from .conftest import SMALL


@pytest.mark.parametrize("table", TABLES)
def test_csv_round_trip_matches_raw(spark, duck, table):
    loaded = warehouse(spark, SMALL).csv_loaded(table)
    problems = compare.diff(loaded.rows, duck, assemble(f"SELECT * FROM raw_{table}"))
    assert not problems, "\n".join(problems)
    assert loaded.rejects.count() == 0


@pytest.mark.parametrize("mode,prefix", [("flag", ""), ("keep_first", "g1_")])
@pytest.mark.parametrize("table", TABLES)
def test_cleaned_and_rejects_match(spark, duck, table, mode, prefix):
    w = warehouse(spark, SMALL)
    for kind, df in (("cleaned", w.cleaned(table, mode)), ("rejects", w.rejects(table, mode))):
        problems = compare.diff(df, duck, assemble(f"SELECT * FROM {prefix}{kind}_{table}"))
        assert not problems, f"{prefix}{kind}_{table}\n" + "\n".join(problems)
