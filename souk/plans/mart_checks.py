"""Validation of the customer mart against the fact and against its own rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import avg_dec, count_if, dec, pct
from ..operators import profile as P
from . import analytics as A
from .warehouse import Warehouse

# ---- fixed values (must equal the reference's literals) ----------------------
MART_NULL_COLUMNS = ["customer_unique_id", "total_orders", "total_spend", "recency_days", "frequency", "monetary",
                     "first_order_date", "last_order_date", "r_score", "f_score", "m_score", "lifecycle_stage",
                     "segment_label", "cohort_month"]
SPEND_TOLERANCE = "0.01"
STAGE_BOUNDARY_VIOLATIONS = {
    "ACTIVE": "recency_days > 30",
    "AT_RISK": "recency_days < 31 OR recency_days > 60",
    "DORMANT": "recency_days <= 60",
}
CONSISTENCY_LABELS = ("CONSISTENT", "DISCREPANCY DETECTED")
# -----------------------------------------------------------------------------


def mart_grain(w: Warehouse) -> DataFrame:
    m, f = w.mart(), w.fact()
    dups = m.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    fact_ids = f.filter(F.col("customer_unique_id").isNotNull()).select("customer_unique_id").distinct()
    missing = fact_ids.join(m.select("customer_unique_id"), "customer_unique_id", "left_anti")
    stats = (m.agg(F.count(F.lit(1)).alias("total"), F.countDistinct("customer_unique_id").alias("distinct_ids"))
             .crossJoin(dups.agg(F.count(F.lit(1)).alias("dups")))
             .crossJoin(fact_ids.agg(F.count(F.lit(1)).alias("fact_ids")))
             .crossJoin(missing.agg(F.count(F.lit(1)).alias("missing"))))
    rows = [("Total rows in mart_customer_features", "total"), ("Distinct customer_unique_ids in mart", "distinct_ids"),
            ("DUPLICATE customer_unique_ids (must be 0)", "dups"),
            ("Distinct customer_unique_ids in fact_order_master", "fact_ids"),
            ("Customers in fact but NOT in mart (must be 0)", "missing")]
    return P._stack(stats, [], rows, "check_name", "value")


def _fact_per_customer(w: Warehouse) -> DataFrame:
    return w.fact().filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(
        F.sum("total_payment_value").alias("fact_spend"), F.count("order_id").alias("fact_orders"))


def spend_consistency(w: Warehouse) -> DataFrame:
    j = w.mart().join(_fact_per_customer(w), "customer_unique_id")
    diff = F.abs(F.sum("total_spend") - F.sum("fact_spend"))
    return j.agg(
        F.round(F.sum("total_spend"), 2).alias("mart_total_spend"),
        F.round(F.sum("fact_spend"), 2).alias("fact_total_payment_value"),
        F.round(diff, 2).alias("absolute_difference"),
        F.when(diff < F.lit(SPEND_TOLERANCE).cast("decimal(3,2)"), F.lit(CONSISTENCY_LABELS[0]))
        .otherwise(F.lit(CONSISTENCY_LABELS[1])).alias("consistency_status"),
    )


def order_consistency(w: Warehouse) -> DataFrame:
    """As written, the mart is joined to unaggregated fact rows, so a customer's
    total_orders is summed once per order row.  The same numbers come from the
    fact pre-aggregated per customer (orders per customer, an order belongs
    to one customer) - no fan-out join; the corrected totals sit alongside."""
    j = w.mart().join(_fact_per_customer(w), "customer_unique_id")
    return j.agg(
        F.sum(F.col("total_orders") * F.col("fact_orders")).alias("mart_total_orders"),
        F.sum("fact_orders").alias("fact_distinct_orders"),
        (F.sum(F.col("total_orders") * F.col("fact_orders")) - F.sum("fact_orders")).alias("difference"),
        F.sum("total_orders").alias("corrected_mart_total_orders"),
        (F.sum("total_orders") - F.sum("fact_orders")).alias("corrected_difference"),
    )


def mart_nulls(w: Warehouse) -> DataFrame:
    return P.null_counts(w.mart(), "mart_customer_features", MART_NULL_COLUMNS).drop("table_name")


def rfm_distribution(w: Warehouse) -> DataFrame:
    m = w.mart()
    parts = [m.groupBy(F.col(s).alias("score")).agg(F.count(F.lit(1)).alias("customers"))
             .select(F.lit(s).alias("score_name"), "score", "customers") for s in ("r_score", "f_score", "m_score")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def rfm_uniformity(w: Warehouse) -> DataFrame:
    g = w.mart().groupBy("r_score").agg(F.count(F.lit(1)).alias("customers"))
    share = F.col("customers") * dec("100.0") / F.sum("customers").over(A.total_window())
    return g.select("r_score", "customers", F.round(share, 2).alias("pct"),
                    F.round(F.abs(share - dec("20.0")), 2).alias("deviation_from_20pct"))


def lifecycle_ranges(w: Warehouse) -> DataFrame:
    viol = None
    for stage, cond in STAGE_BOUNDARY_VIOLATIONS.items():
        c = (F.col("lifecycle_stage") == stage) & F.expr(cond)
        viol = c if viol is None else (viol | c)
    return w.mart().groupBy("lifecycle_stage").agg(
        F.min("recency_days").alias("min_recency"), F.max("recency_days").alias("max_recency"),
        F.count(F.lit(1)).alias("customers"), count_if(viol).alias("boundary_violations"))


def retention_flags(w: Warehouse) -> DataFrame:
    return w.mart().groupBy("repeat_purchase_flag").agg(
        F.min("total_orders").alias("min_orders"), F.max("total_orders").alias("max_orders"),
        F.count(F.lit(1)).alias("customers"),
        count_if((F.col("repeat_purchase_flag") == 1) & (F.col("total_orders") < 2)).alias("repeat_flag_violations"),
        count_if((F.col("is_one_time_buyer") == 1) & (F.col("total_orders") > 1)).alias("one_time_flag_violations"),
        count_if((F.col("repeat_purchase_flag") == 1) & (F.col("customer_lifetime_days") > 0)
                 & F.col("avg_days_between_orders").isNull()).alias("missing_gap_violations"))


def cohort_distribution(w: Warehouse) -> DataFrame:
    return w.mart().groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("new_customers"), F.sum("repeat_purchase_flag").cast("bigint").alias("repeat_buyers"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"))


def ratio_bounds(w: Warehouse) -> DataFrame:
    def bad(c):
        return count_if((F.col(c) < 0) | (F.col(c) > 1))

    r = F.col("avg_customer_review_score")
    return w.mart().agg(
        bad("delayed_order_ratio").alias("invalid_delayed_ratio"),
        bad("multi_item_ratio").alias("invalid_multi_item_ratio"),
        bad("multi_payment_ratio").alias("invalid_multi_payment_ratio"),
        bad("high_value_order_ratio").alias("invalid_hv_ratio"),
        count_if(r.isNotNull() & ((r < 1) | (r > 5))).alias("invalid_review_score_range"),
        F.min(r).alias("min_review"), F.max(r).alias("max_review"), F.round(F.avg(r), 2).alias("overall_avg_review"))


def behaviour_summary(w: Warehouse) -> DataFrame:
    return w.mart().agg(
        F.round(F.avg("avg_delivery_delay"), 2).alias("avg_delivery_delay_overall"),
        F.round(F.avg("delayed_order_ratio"), 4).alias("avg_delayed_ratio"),
        F.round(F.avg("multi_item_ratio"), 4).alias("avg_multi_item_ratio"),
        F.round(F.avg("multi_payment_ratio"), 4).alias("avg_multi_payment_ratio"),
        F.round(F.avg("avg_items_per_order"), 2).alias("avg_items_per_order_overall"),
        count_if(F.col("avg_delivery_delay").isNull()).alias("customers_no_delivery_data"))


def segment_sanity(w: Warehouse) -> DataFrame:
    g = w.mart().groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("customers"), A.avg2("total_spend").alias("avg_spend"),
        A.avg_int("total_orders").alias("avg_orders"), A.avg_int("recency_days", 0).alias("avg_recency_days"),
        A.avg_int("rfm_score").alias("avg_rfm_score"))
    return g.select("segment_label", "customers", A.share_of_total("customers").alias("pct"), "avg_spend",
                    "avg_orders", "avg_recency_days", "avg_rfm_score")


def lifecycle_spend(w: Warehouse) -> DataFrame:
    g = w.mart().groupBy("lifecycle_stage").agg(
        F.sum("total_spend").alias("total_revenue"), F.count(F.lit(1)).alias("customers"),
        A.avg2("total_spend").alias("avg_spend"), A.avg_int("total_orders").alias("avg_orders"))
    return g.select("*", A.share_of_total("total_revenue").alias("revenue_share_pct"))


def mart_top_states(w: Warehouse, n: int = 10) -> DataFrame:
    g = w.mart().groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_orders").alias("total_orders"),
        A.money("total_spend").alias("total_revenue"), A.avg2("total_spend").alias("avg_customer_spend"))
    return g.orderBy(F.col("total_revenue").desc(), F.col("customer_state").asc_nulls_first()).limit(n)


def cohort_heatmap(w: Warehouse) -> DataFrame:
    return w.mart().groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("total_customers"), F.sum("is_one_time_buyer").cast("bigint").alias("one_time_buyers"),
        F.sum("repeat_purchase_flag").cast("bigint").alias("repeat_buyers"),
        avg_dec("total_orders", 2, in_scale=0).alias("avg_orders"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
        A.avg2("total_spend").alias("avg_ltv"))
