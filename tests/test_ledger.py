"""Counts collected at write time against a rescan, the reject log, and rows in the tagged format."""

import json

from pyspark.sql import functions as F

from souk.operators.tagged import replace_run, tagged_rows
from souk.plans import cleaning
from souk.plans.warehouse import GENERATIONS, materialize, warehouse

from .conftest import SMALL


def test_ledger_equals_a_rescan(spark):
    w = warehouse(spark, SMALL)
    got = {(r.table_name, r.measure): r.value for r in w.ledger().collect()}
    flag = lambda t: "is_out_of_bounds" if t == "geolocation" else "duplicate_flag"
    for name, (layer, gen, t) in w.cleaning_tables().items():
        df = getattr(w, layer)(t, GENERATIONS[gen])
        assert got[name, "rows"] == df.count(), name
        if layer == "rejects":
            assert got[name, "represented"] == (df.agg(F.sum("rejected_row_count")).first()[0] or 0), name
        elif flag(t) in df.columns:
            assert got[name, "flagged"] == (df.agg(F.sum(flag(t))).first()[0] or 0), name
    for t, df in w.raw_all().items():
        assert got[f"raw_{t}", "rows"] == df.count()
    assert got["fact_order_master", "rows"] == w.fact().count() and got["mart_customer_features", "rows"] == w.mart().count()


def test_accounting_reads_the_ledger_alone(spark):
    from souk.plans import checks as CK

    w = warehouse(spark, SMALL)
    for df in (CK.row_accounting(w), CK.clean_summary(w), CK.reject_breakdown(w)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Union" not in plan


def test_empty_tables_are_counted(spark, tmp_path):
    from pyspark.sql import Observation

    for df in (spark.createDataFrame([], "a int"), spark.range(5).filter("id > 9").select("id")):
        seen = Observation()
        materialize(spark, df, str(tmp_path / "t"), observe=(seen, [F.count(F.lit(1)).alias("rows")]))
        assert dict(seen.get) in ({"rows": 0}, {})


def test_reject_log_is_replaced_by_the_same_run(spark, tmp_path):
    path = str(tmp_path / "log")
    parts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "generation bigint, table_name string")
    rows = lambda *r: spark.createDataFrame(list(r), "generation bigint, table_name string, key_value string")
    read = lambda df: sorted(tuple(x) for x in df.collect())
    first = [(1, "a", "k1"), (1, "b", "k2"), (2, "a", "k3")]
    assert read(replace_run(rows(*first), path, "run1", parts)) == [("run1", *r) for r in first]
    assert read(replace_run(rows(*first), path, "run1", parts)) == [("run1", *r) for r in first]  # not doubled
    both = read(replace_run(rows(*first[:2]), path, "run2", parts))
    assert both == [("run1", *r) for r in first] + [("run2", *r) for r in first[:2]]  # another run is appended
    again = read(replace_run(rows((1, "a", "k9")), path, "run1", parts))  # tables that have no reject any more
    assert again == [("run1", 1, "a", "k9")] + [("run2", *r) for r in first[:2]]


def test_warehouse_log_twice(spark):
    w = warehouse(spark, SMALL)
    n = w.reject_log("x").filter("run_id = 'x'").count()
    assert n == sum(w.rejects(t, m).count() for t in w.raw_all() for m in GENERATIONS.values()) > 0
    assert w.reject_log("x").filter("run_id = 'x'").count() == n
    assert w.reject_log("y").filter("run_id = 'x'").count() == n


def test_tagged_rows_keep_nulls_and_quotes(spark):
    df = spark.createDataFrame([(1, None, 'a "q" \\ ä'), (None, "x|y", "")], "id int, k string, v string")
    got = sorted(tuple(r) for r in tagged_rows(df, 2, "t", ["id", "k"], ["id", "k", "v"]).collect())
    assert [(r[0], r[1], r[2], json.loads(r[3])) for r in got] == [
        (2, "t", "1|NULL", {"id": "1", "k": None, "v": 'a "q" \\ ä'}), (2, "t", "NULL|x|y", {"id": None, "k": "x|y", "v": ""})]


def test_every_table_with_a_rule_is_answered(spark):
    """Per key, the tables of the tagged answer are those whose specification has the rule."""
    from souk.plans import checks as CK

    w = warehouse(spark, SMALL)
    tables = lambda df: {(r.generation, r.table_name) for r in df.select("generation", "table_name").distinct().collect()}
    specs = {1: cleaning.gen1_specs(), 2: cleaning.gen2_specs()}
    assert tables(CK.rule_rejects(w)) <= {(g, t) for g in specs for t, s in specs[g].items() if s.rules}
    assert {t for _, t in tables(CK.rule_rejects(w))} >= {"order_items", "payments", "reviews", "geolocation"}
    assert tables(CK.kept_rows(w)) == {(1, t) for t, s in specs[1].items() if s.dup_reason}
    assert tables(CK.standardized_texts(w)) == {(g, t) for g in specs for t, s in specs[g].items() if s.normalise}
