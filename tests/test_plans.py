"""Plan-shape tests: what must (not) appear in the physical plans at scale."""

from souk.plans import analytics as A
from souk.plans.warehouse import warehouse

from .conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_rankings_never_use_a_single_partition(spark):
    from pyspark.sql import functions as F

    from souk.operators.ranking import SortKey, rank_buckets

    w = warehouse(spark, SMALL)
    base = w.mart().filter(F.col("total_spend") > 0).select("customer_unique_id", "total_spend")
    r = rank_buckets(base, [SortKey("total_spend", True)], ["customer_unique_id"], sum_col="total_spend",
                     buckets=6)
    assert len(r.counts) > 1
    plan = _plan(r.with_running_sum("s", "rn"))
    assert "SinglePartition" not in plan
    assert "hashpartitioning(_bucket" in plan


def test_top_k_per_group_uses_window_group_limit(spark):
    w = warehouse(spark, SMALL)
    assert "WindowGroupLimit" in _plan(A.segment_top_customers(w.mart()))


def test_no_python_udfs_anywhere(spark):
    w = warehouse(spark, SMALL)
    for df in (w.fact(), w.mart(), A.cohort_retention_matrix(w.active_months())):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_filters_reach_the_parquet_scan(spark):
    w = warehouse(spark, SMALL)
    plan = _plan(w.fact().filter("order_year = 2000").select("order_id", "total_payment_value"))
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert "ReadSchema: struct<order_id:string,total_payment_value:decimal(18,2)>" in plan


def test_customer_measures_stay_hash_aggregated(spark):
    from souk.plans.mart import customer_agg, reference_date

    w = warehouse(spark, SMALL)
    ref = reference_date(w.fact()).first()[0]
    plan = _plan(customer_agg(w.fact(), ref))
    assert "SortAggregate" not in plan


def test_last_location_needs_no_sort_aggregate(spark):
    from souk.plans.mart import last_location

    w = warehouse(spark, SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(last_location(w.fact(), w.customer_agg()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortAggregate" not in plan, plan
    # the join's keys hold the time too, so the orders of a hot customer are spread
    assert "hashpartitioning(customer_unique_id" in plan and "coalesce(order_purchase_timestamp" in plan


def test_cohort_answers_read_the_bitmaps_alone(spark):
    from souk.plans import views as V

    w = warehouse(spark, SMALL)
    m = w.active_months()
    for df in (A.cohort_retention_matrix(m), A.retention_by_period(m), A.new_vs_returning(m), V.vw_cohort_retention(m)):
        plan = _plan(df)
        assert plan.count("FileScan") == 1 and "customer_active_months" in plan and "Join" not in plan
    from souk.plans.analytics import active_months

    assert "SortAggregate" not in _plan(active_months(w.fact()))


def test_bitmaps_over_many_years(spark):
    from datetime import datetime

    from souk.plans.analytics import WORD, active_months, month_label, new_vs_returning

    rows = [("a", datetime(1990, 12, 31)), ("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 31)), ("b", datetime(2001, 6, 1)),
            ("c", None), (None, datetime(1900, 1, 1))] + [("hot", datetime(1991 + k // 12 % 30, k % 12 + 1, 3)) for k in range(700)]
    m = active_months(spark.createDataFrame(rows, "customer_unique_id string, order_purchase_timestamp timestamp_ntz")).cache()
    assert {r.customer_unique_id: r.first for r in m.select("customer_unique_id", month_label("first_month").alias("first")).collect()} == {
        "a": "1990-12", "b": "2001-06", "hot": "1991-01"}
    got = {r.order_month: (r.new_customers, r.returning_customers) for r in new_vs_returning(m).collect()}
    months = {(c, t.strftime("%Y-%m")) for c, t in rows if c and t}
    first = {c: min(x for d, x in months if d == c) for c, _ in months}
    assert got == {x: (sum(first[c] == x for c, y in months if y == x), sum(first[c] != x for c, y in months if y == x)) for _, x in months}
    assert m.first().months and len(m.first().months) == (2024 * 12 + 1 - 1990 * 12 - 12) // WORD + 1
    assert new_vs_returning(active_months(spark.createDataFrame([], "customer_unique_id string, order_purchase_timestamp timestamp_ntz"))).count() == 0


def test_fact_joins_read_bucketed_aggregates_without_shuffle(spark):
    from souk.plans import fact as FP

    w = warehouse(spark, SMALL)
    cleaned = {t: w.cleaned(t) for t in ("orders", "customers", "category_translation")}
    aggs = w.order_aggs()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = FP.build_fact(cleaned, w.threshold(), aggs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the five per-order aggregates are scanned as buckets: no exchange on their side of the joins
    assert plan.count("Bucketed: true") >= 5
    for name in aggs:
        scan = [ln for ln in plan.splitlines() if name in ln and "FileScan" in ln]
        assert scan, name
