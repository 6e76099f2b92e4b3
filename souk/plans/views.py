"""The nine reporting views: lazily evaluated DataFrames registered by name.

ORDER BY inside a view is not a contract; readers order.  Views over the
whole customer table (Pareto) use the range ranking operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import dec, pct
from ..operators.ranking import Ranked, ntile_from_rank
from . import analytics as A

# ---- fixed values (must equal the reference's literals) ----------------------
SEGMENT_SORT_ORDER = [
    "champions", "loyal", "high_value", "cannot_lose", "potential_loyalist",
    "new_customer", "churn_risk", "at_risk", "hibernating", "lost",
]
SEGMENT_SORT_DEFAULT = 11
STAGE_SORT_ORDER = ["ACTIVE", "AT_RISK", "DORMANT"]
RETENTION_BANDS = [(20, "High"), (10, "Medium")]
RETENTION_BAND_DEFAULT = "Low"
PARETO_TIERS = [(20, "Top 20%"), (50, "Middle 30%")]
PARETO_TIER_DEFAULT = "Bottom 50%"
RISK_HIGH = "delayed_order_ratio >= 0.5 AND avg_customer_review_score < 3 AND cancelled_orders >= 1"
RISK_MEDIUM = "delayed_order_ratio >= 0.25 OR avg_customer_review_score < 3"
RISK_TIERS = ("High Risk", "Medium Risk", "Low Risk")
# -----------------------------------------------------------------------------


def _share_no_nullif(c: str):
    """ROUND(x * 100.0 / SUM(x) OVER (), 2) - the views divide without NULLIF."""
    return F.round(F.col(c) * dec("100.0") / F.sum(c).over(A.total_window()), 2)


def vw_kpi_executive(mart: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    at_risk_spend = F.when(F.col("lifecycle_stage").isin("AT_RISK", "DORMANT"), F.col("total_spend")).otherwise(dec("0"))
    return mart.agg(
        F.count("customer_unique_id").alias("total_unique_customers"),
        A.money("total_spend").alias("total_revenue_brl"),
        A.avg2("avg_order_value").alias("avg_order_value_brl"),
        F.sum("total_orders").alias("total_orders_placed"),
        F.round(F.sum("total_spend") / F.when(F.sum("total_orders") != 0, F.sum("total_orders")), 2)
        .alias("revenue_per_order"),
        pct(F.sum("repeat_purchase_flag"), n).alias("repeat_customer_pct"),
        pct(F.sum("is_one_time_buyer"), n).alias("one_time_buyer_pct"),
        A.stage_pct("ACTIVE").alias("active_pct"),
        A.stage_pct("AT_RISK").alias("at_risk_pct"),
        A.stage_pct("DORMANT").alias("dormant_pct"),
        A.avg2("avg_customer_review_score").alias("avg_review_score"),
        A.avg2("avg_delivery_delay").alias("avg_delivery_delay_days"),
        A.avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_rate_pct"),
        F.round(F.sum(at_risk_spend), 2).alias("revenue_at_risk_brl"),
        F.min("cohort_month").alias("first_cohort_month"),
        F.max("cohort_month").alias("last_cohort_month"),
    )


def vw_pareto_revenue(r: Ranked) -> DataFrame:
    cols = A.SPEND_RANK_COLUMNS
    rows = r.with_running_sum("cumulative_spend", "spend_rank")
    n = F.lit(r.n).cast("bigint")
    grand = F.lit(r.total_sum).cast("decimal(38,2)")
    share = F.col("spend_rank") * dec("100.0") / n
    tier = F.when(share <= PARETO_TIERS[0][0], F.lit(PARETO_TIERS[0][1])) \
        .when(share <= PARETO_TIERS[1][0], F.lit(PARETO_TIERS[1][1])).otherwise(F.lit(PARETO_TIER_DEFAULT))
    return rows.select(
        *cols, "spend_rank", n.alias("total_customers"),
        F.round(share, 2).alias("customer_percentile"),
        F.round(F.col("cumulative_spend") * dec("100.0") / grand, 2).alias("cumulative_revenue_pct"),
        ntile_from_rank(F.col("spend_rank"), r.n, 10).alias("spend_decile"),
        tier.alias("customer_tier"),
    )


def _sort_order(c: str, order: list[str], default=None):
    out = None
    for i, v in enumerate(order, start=1):
        out = F.when(F.col(c) == v, F.lit(i)) if out is None else out.when(F.col(c) == v, F.lit(i))
    return out.otherwise(F.lit(default)) if default is not None else out


def vw_segment_summary(mart: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    g = mart.groupBy("segment_label").agg(
        n.alias("customer_count"), F.sum("total_spend").alias("_rev"),
        A.avg2("avg_order_value").alias("avg_order_value"),
        A.avg_int("total_orders").alias("avg_orders"),
        A.avg_int("recency_days", 0).alias("avg_recency_days"),
        A.avg_int("rfm_score").alias("avg_rfm_score"),
        pct(F.sum("repeat_purchase_flag"), n).alias("repeat_rate_pct"),
        A.avg2("avg_customer_review_score").alias("avg_review_score"),
        A.avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_pct"),
        A.avg_int("customer_lifetime_days", 0).alias("avg_lifetime_days"),
    )
    return g.select(
        "segment_label", "customer_count", A.share_of_total("customer_count").alias("customer_share_pct"),
        F.round("_rev", 2).alias("total_revenue"), _share_no_nullif("_rev").alias("revenue_share_pct"),
        "avg_order_value", "avg_orders", "avg_recency_days", "avg_rfm_score", "repeat_rate_pct",
        "avg_review_score", "avg_delay_pct", "avg_lifetime_days",
        _sort_order("segment_label", SEGMENT_SORT_ORDER, SEGMENT_SORT_DEFAULT).alias("segment_sort_order"),
    )


def vw_lifecycle_summary(mart: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    g = mart.groupBy("lifecycle_stage").agg(
        n.alias("customer_count"), F.sum("total_spend").alias("_rev"),
        A.avg2("total_spend").alias("avg_customer_ltv"),
        A.avg2("avg_order_value").alias("avg_order_value"),
        A.avg_int("recency_days", 0).alias("avg_recency_days"),
        pct(F.sum("repeat_purchase_flag"), n).alias("repeat_rate_pct"),
        A.avg2("avg_customer_review_score").alias("avg_review_score"),
        A.avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_pct"),
    )
    return g.select(
        "lifecycle_stage", "customer_count", A.share_of_total("customer_count").alias("customer_share_pct"),
        F.round("_rev", 2).alias("lifecycle_revenue"), _share_no_nullif("_rev").alias("revenue_share_pct"),
        "avg_customer_ltv", "avg_order_value", "avg_recency_days", "repeat_rate_pct", "avg_review_score",
        "avg_delay_pct", _sort_order("lifecycle_stage", STAGE_SORT_ORDER).alias("stage_sort_order"),
    )


def vw_cohort_retention(months: DataFrame) -> DataFrame:
    a = A.cohort_activity(months)
    rate = F.round(F.col("active_customers") * dec("100.0") / F.col("cohort_size"), 2)
    band = F.when(rate >= RETENTION_BANDS[0][0], F.lit(RETENTION_BANDS[0][1])) \
        .when(rate >= RETENTION_BANDS[1][0], F.lit(RETENTION_BANDS[1][1])).otherwise(F.lit(RETENTION_BAND_DEFAULT))
    return a.select(
        "cohort_month", F.col("cohort_size").alias("initial_customers"),
        F.col("period_num").alias("months_after_first_order"),
        F.col("active_customers").alias("returning_customers"), rate.alias("retention_pct"),
        band.alias("retention_band"),
    )


def vw_monthly_revenue_trend(fact: DataFrame) -> DataFrame:
    m = A.monthly_fact(fact)
    t = A._trend_columns()
    return m.select(
        "order_month", "order_year", "order_month_num", "order_count", "unique_customers", "revenue",
        "items_revenue", "freight_revenue", "avg_order_value", "avg_review_score", "delayed_orders",
        "delay_rate_pct", t["prev"], t["growth"], t["rolling"].alias("rolling_3mo_avg"), t["ytd"].alias("ytd_revenue"),
    )


def vw_risk_behavior(mart: DataFrame) -> DataFrame:
    tier = F.when(F.expr(RISK_HIGH), F.lit(RISK_TIERS[0])).when(F.expr(RISK_MEDIUM), F.lit(RISK_TIERS[1])) \
        .otherwise(F.lit(RISK_TIERS[2]))
    return mart.select(
        "customer_unique_id", "lifecycle_stage", "segment_label", "delayed_order_ratio", "multi_item_ratio",
        "multi_payment_ratio", "high_value_order_ratio", "avg_delivery_delay", "avg_customer_review_score",
        "total_spend", "total_orders", "cancelled_orders",
        pct(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate_pct"),
        tier.alias("customer_risk_tier"),
    )


def vw_geographic_summary(mart: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    g = mart.filter(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        n.alias("total_customers"), F.sum("total_spend").alias("_rev"),
        A.avg2("total_spend").alias("avg_customer_ltv"),
        A.avg2("avg_order_value").alias("avg_order_value"),
        pct(F.sum("repeat_purchase_flag"), n).alias("repeat_rate_pct"),
        A.stage_pct("ACTIVE").alias("active_pct"),
        A.stage_pct("DORMANT").alias("dormant_pct"),
        A.avg2("avg_customer_review_score").alias("avg_review"),
    )
    return g.select(
        "customer_state", "total_customers", F.round("_rev", 2).alias("total_revenue"),
        _share_no_nullif("_rev").alias("revenue_share_pct"), "avg_customer_ltv", "avg_order_value",
        "repeat_rate_pct", "active_pct", "dormant_pct", "avg_review",
        F.dense_rank().over(Window.orderBy(F.col("_rev").desc())).alias("revenue_rank"),
    )


def vw_customer_profile_distribution(mart: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    g = mart.groupBy("rfm_score", "rfm_label", "r_score", "f_score", "m_score").agg(
        n.alias("customer_count"), A.money("total_spend").alias("total_revenue"),
        A.avg2("total_spend").alias("avg_ltv"), A.avg2("avg_order_value").alias("avg_order_value"),
        A.avg_int("recency_days", 0).alias("avg_recency_days"),
    )
    return g.select("rfm_score", "rfm_label", "r_score", "f_score", "m_score", "customer_count",
                    A.share_of_total("customer_count").alias("pct_of_customers"), "total_revenue", "avg_ltv",
                    "avg_order_value", "avg_recency_days")


def register_views(spark: SparkSession, fact: DataFrame, mart: DataFrame, dims: dict[str, DataFrame], ranking: Ranked,
                   months: DataFrame) -> list[str]:
    """CREATE VIEW: register the nine reporting views and the one-row-per-key views as temp views; returns the names."""
    views = {
        **{f"vw_{name}": df for name, df in dims.items()},
        "vw_pareto_revenue": vw_pareto_revenue(ranking),
        "vw_kpi_executive": vw_kpi_executive(mart),
        "vw_segment_summary": vw_segment_summary(mart),
        "vw_lifecycle_summary": vw_lifecycle_summary(mart),
        "vw_cohort_retention": vw_cohort_retention(months),
        "vw_monthly_revenue_trend": vw_monthly_revenue_trend(fact),
        "vw_risk_behavior": vw_risk_behavior(mart),
        "vw_geographic_summary": vw_geographic_summary(mart),
        "vw_customer_profile_distribution": vw_customer_profile_distribution(mart),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
