"""The 25 analytics questions over the mart and the fact.

Most answers are "aggregate the mart by a small key, then window over the
aggregate" - the window runs on tens of rows.  Deciles and the median are found from counts of
values; Pareto, which needs every customer's rank, uses the range ranking operator: no
plan contains a single-partition window over the mart.  Cohort and retention questions read one
bitmap of active months per customer, neither the fact nor the mart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (
    LIFECYCLE_ORDER, WEEKDAYS, avg_dec, bucketize, count_if, dec, field_position, month_index, nullif, pct,
    year_month,
)
from ..operators.ranking import Ranked, SortKey, rank_buckets
from ..operators.selection import median_values, tiles

def total_window() -> Window:
    """OVER () - only ever applied to small aggregated frames (tens of rows)."""
    return Window.partitionBy()

# ---- fixed values (must equal the reference's literals) ----------------------
PARETO_BANDS = [1, 5, 10, 15, 20, 25, 30, 40, 50, 75, 100]
DORMANCY_BUCKETS = [
    (61, 120, "61–120 days (recoverable)"),
    (121, 180, "121–180 days (difficult)"),
    (181, 365, "181–365 days (unlikely)"),
]
DORMANCY_DEFAULT = "Over 365 days (lost)"
DELAY_RATIO_BUCKETS = [
    ("0% – No delays", "delayed_order_ratio = 0"),
    ("1–25% delayed", "delayed_order_ratio BETWEEN 0.01 AND 0.25"),
    ("26–50% delayed", "delayed_order_ratio BETWEEN 0.26 AND 0.50"),
    ("51–75% delayed", "delayed_order_ratio BETWEEN 0.51 AND 0.75"),
]
DELAY_RATIO_DEFAULT = "76–100% delayed"
HIGH_VALUE_BUCKETS = [
    ("Always High-Value (100%)", "high_value_order_ratio = 1.0"),
    ("Mostly High-Value (75–99%)", "high_value_order_ratio >= 0.75"),
    ("Often High-Value (50–74%)", "high_value_order_ratio >= 0.50"),
    ("Sometimes High-Value (25–49%)", "high_value_order_ratio >= 0.25"),
    ("Rarely High-Value (1–24%)", "high_value_order_ratio > 0"),
]
HIGH_VALUE_DEFAULT = "Never High-Value (0%)"
REPURCHASE_BUCKETS = [
    ("0–7 days", "avg_days_between_orders BETWEEN 0 AND 7"),
    ("8–30 days", "avg_days_between_orders BETWEEN 8 AND 30"),
    ("31–90 days", "avg_days_between_orders BETWEEN 31 AND 90"),
    ("91–180 days", "avg_days_between_orders BETWEEN 91 AND 180"),
]
REPURCHASE_DEFAULT = "180+ days"
RETENTION_PERIODS = (0, 11)
BUYER_TYPES = ("Repeat Buyer", "One-Time Buyer")
# -----------------------------------------------------------------------------


def _rules(rules, default) -> Column:
    return bucketize(None, [(F.expr(c), label) for label, c in rules], default)


def share_of_total(c: str, digits: int = 2) -> Column:
    """ROUND(x * 100.0 / NULLIF(SUM(x) OVER (), 0), d) over a small aggregate."""
    return pct(F.col(c), F.sum(c).over(total_window()), digits)


def money(c) -> Column:
    return F.round(F.sum(c), 2)


def avg2(c, digits=2) -> Column:
    """ROUND(AVG(decimal column), d)."""
    return F.round(F.avg(c), digits)


def avg_int(c, digits=2) -> Column:
    """ROUND(AVG(integer column), d), integer averaged as DECIMAL like SQL engines with exact AVG."""
    return avg_dec(c, digits, in_scale=0)


def avg_pct_of_ratio(c) -> Column:
    return F.round(F.avg(c) * F.lit(100), 2)


def stage_pct(stage: str) -> Column:
    return pct(count_if(F.col("lifecycle_stage") == stage), F.count(F.lit(1)))


# ---- 1. KPI layer -----------------------------------------------------------------

def _median(values: DataFrame, col: str) -> Column:
    """Median as the mean of the rows at positions floor((n+1)/2) and ceil((n+1)/2)."""
    vals = median_values(values, col)
    return F.lit(sum(vals) / len(vals)).cast("decimal(22,6)") if vals else F.lit(None).cast("decimal(18,2)")


def kpi_summary(mart: DataFrame) -> DataFrame:
    median = _median(mart.select("avg_order_value").filter(F.col("avg_order_value").isNotNull()), "avg_order_value")
    n = F.count(F.lit(1))
    return mart.agg(
        F.count("customer_unique_id").alias("total_unique_customers"),
        money("total_spend").alias("total_revenue_brl"),
        avg2("avg_order_value").alias("overall_avg_order_value"),
        F.round(median, 2).alias("median_order_value"),
        F.sum("total_orders").alias("total_orders_placed"),
        F.round(F.sum("total_spend") / nullif(F.sum("total_orders"), 0), 2).alias("revenue_per_order"),
        pct(F.sum("repeat_purchase_flag"), n).alias("repeat_customer_pct"),
        pct(F.sum("is_one_time_buyer"), n).alias("one_time_buyer_pct"),
        stage_pct("ACTIVE").alias("active_pct"),
        stage_pct("AT_RISK").alias("at_risk_pct"),
        stage_pct("DORMANT").alias("dormant_pct"),
        avg2("avg_customer_review_score").alias("avg_review_score"),
        avg2("avg_delivery_delay").alias("avg_delivery_delay_days"),
        avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_rate_pct"),
        F.min("cohort_month").alias("first_customer_cohort"),
        F.max("cohort_month").alias("last_customer_cohort"),
    )


SPEND_RANK_COLUMNS = ("customer_unique_id", "total_spend", "segment_label", "lifecycle_stage")


def spend_ranking(mart: DataFrame) -> Ranked:
    """Customers with spend > 0 ranked by spend desc (id breaks ties), with running spend: one ranking serves
    both Pareto answers and the Pareto view (the warehouse keeps it)."""
    base = mart.filter(F.col("total_spend") > 0).select(*SPEND_RANK_COLUMNS)
    return rank_buckets(base, [SortKey("total_spend", True)], ["customer_unique_id"], sum_col="total_spend")


def revenue_deciles(mart: DataFrame) -> DataFrame:
    base = mart.filter(F.col("total_spend") > 0).select("customer_unique_id", "total_spend")
    decile = tiles(base, {"spend": SortKey("total_spend", True)}, "customer_unique_id", 10)["spend"]
    scored = base.withColumn("spend_decile", decile.cast("bigint"))
    g = scored.groupBy("spend_decile").agg(F.count(F.lit(1)).alias("customer_count"),
                                           F.sum("total_spend").alias("_rev"))
    running = F.sum("_rev").over(Window.orderBy("spend_decile").rowsBetween(Window.unboundedPreceding, 0))
    return g.select(
        F.col("spend_decile").alias("customer_decile"),
        "customer_count",
        F.round("_rev", 2).alias("decile_revenue"),
        share_of_total("_rev").alias("revenue_share_pct"),
        pct(running, F.sum("_rev").over(total_window())).alias("cumulative_revenue_pct"),
    )


# ---- 2. Pareto --------------------------------------------------------------------

def _pareto_rows(r: Ranked, pct_digits: int) -> DataFrame:
    rows = r.with_running_sum("cumulative_spend", "spend_rank")
    total = F.lit(r.n).cast("bigint")
    grand = F.lit(r.total_sum).cast("decimal(38,2)")
    return rows.select(
        "*",
        pct(F.col("spend_rank"), total, pct_digits).alias("customer_pct"),
        pct(F.col("cumulative_spend"), grand).alias("cumulative_revenue_pct"),
        total.alias("total_customers"),
    )


def pareto_bands(ranking: Ranked) -> DataFrame:
    p = _pareto_rows(ranking, 4).withColumn("_band", F.round("customer_pct", 0))
    g = p.filter(F.col("_band").isin(*PARETO_BANDS)).groupBy("_band").agg(
        F.max("spend_rank").alias("max_customer_rank"),
        F.round(F.max("cumulative_revenue_pct"), 2).alias("cumulative_revenue_pct"),
        F.count(F.lit(1)).alias("customers_in_band"),
    )
    return g.select(
        F.concat(F.lit("Top "), F.col("_band").cast("bigint").cast("string"), F.lit("%")).alias("customer_band"),
        "max_customer_rank", "cumulative_revenue_pct", "customers_in_band",
    )


def pareto_80_threshold(ranking: Ranked) -> DataFrame:
    p = _pareto_rows(ranking, 2).filter(F.col("cumulative_revenue_pct") >= 80)
    return p.agg(
        F.min("spend_rank").alias("customers_needed_for_80pct_revenue"),
        F.round(F.min("customer_pct"), 2).alias("customer_percentile_that_drives_80pct"),
        F.min("cumulative_revenue_pct").alias("actual_cumulative_revenue_pct"),
    )


# ---- 3. Segments --------------------------------------------------------------------

def segment_metrics(mart: DataFrame) -> DataFrame:
    g = mart.groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_spend").alias("_rev"),
        avg2("avg_order_value").alias("avg_order_value"),
        avg_int("total_orders").alias("avg_orders_per_customer"),
        avg_int("recency_days", 0).alias("avg_recency_days"),
        avg_int("rfm_score").alias("avg_rfm_score"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
        avg2("avg_customer_review_score").alias("avg_review_score"),
        avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_rate_pct"),
        avg_int("customer_lifetime_days", 0).alias("avg_lifetime_days"),
    )
    return g.select(
        "segment_label", "customer_count", share_of_total("customer_count").alias("customer_share_pct"),
        F.round("_rev", 2).alias("segment_revenue"), share_of_total("_rev").alias("revenue_share_pct"),
        "avg_order_value", "avg_orders_per_customer", "avg_recency_days", "avg_rfm_score",
        "repeat_rate_pct", "avg_review_score", "avg_delay_rate_pct", "avg_lifetime_days",
    )


def segment_ranking(mart: DataFrame) -> DataFrame:
    seg = mart.groupBy("segment_label").agg(F.sum("total_spend").alias("revenue"),
                                            F.count(F.lit(1)).alias("customers"))
    seg = seg.select("*", share_of_total("revenue").alias("revenue_pct"),
                     share_of_total("customers").alias("customer_pct"))
    order = Window.orderBy(F.col("revenue").desc(), F.col("segment_label"))
    return seg.select(
        "segment_label", F.round("revenue", 2).alias("segment_revenue"), "customers", "revenue_pct",
        "customer_pct", F.round(F.col("revenue_pct") - F.col("customer_pct"), 2).alias("revenue_customer_gap"),
        F.dense_rank().over(Window.orderBy(F.col("revenue").desc())).alias("revenue_rank"),
        F.round(F.sum("revenue_pct").over(order.rowsBetween(Window.unboundedPreceding, 0)), 2)
        .alias("cumulative_revenue_pct"),
    )


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """ROW_NUMBER() <= k per group; Spark plans a partial WindowGroupLimit before the
    shuffle, so each task forwards at most k rows per group (no whole-group sort)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def segment_top_customers(mart: DataFrame) -> DataFrame:
    cols = ["segment_label", "customer_unique_id", "total_spend", "total_orders", "recency_days", "rfm_label",
            "lifecycle_stage"]
    return top_k_per_group(mart.select(*cols), "segment_label",
                           [F.col("total_spend").desc(), F.col("customer_unique_id")], 5)


# ---- 4. Lifecycle --------------------------------------------------------------------

def lifecycle_distribution(mart: DataFrame) -> DataFrame:
    g = mart.groupBy("lifecycle_stage").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_spend").alias("_rev"),
        avg2("total_spend").alias("avg_customer_value"),
        avg_int("total_orders").alias("avg_orders"),
        avg_int("recency_days", 0).alias("avg_recency_days"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
        avg2("avg_customer_review_score").alias("avg_review_score"),
    )
    return g.select(
        "lifecycle_stage", "customer_count", share_of_total("customer_count").alias("customer_share_pct"),
        F.round("_rev", 2).alias("lifecycle_revenue"), share_of_total("_rev").alias("revenue_share_pct"),
        "avg_customer_value", "avg_orders", "avg_recency_days", "repeat_rate_pct", "avg_review_score",
    ).orderBy(field_position("lifecycle_stage", LIFECYCLE_ORDER))


def revenue_at_risk(mart: DataFrame) -> DataFrame:
    m = mart.filter(F.col("lifecycle_stage") == "AT_RISK")
    months = F.greatest(F.col("customer_lifetime_days") / F.lit(30.0), F.lit(1.0))
    per_month = F.col("total_orders") / nullif(months, 0)
    return m.agg(
        F.lit("AT_RISK customers").alias("category"),
        F.count(F.lit(1)).alias("customer_count"),
        money("total_spend").alias("historic_spend"),
        avg2("avg_order_value").alias("avg_order_value"),
        F.round(F.avg(per_month), 2).alias("avg_orders_per_month"),
        F.round(F.count(F.lit(1)) * F.avg(F.col("avg_order_value").cast("double")) * F.avg(per_month) * 12, 2)
        .alias("projected_12mo_revenue_if_retained"),
    )


def dormant_recovery(mart: DataFrame) -> DataFrame:
    m = mart.filter(F.col("lifecycle_stage") == "DORMANT")
    bucket = bucketize(None, [(F.col("recency_days").between(lo, hi), label) for lo, hi, label in DORMANCY_BUCKETS],
                       DORMANCY_DEFAULT)
    return m.withColumn("dormancy_bucket", bucket).groupBy("dormancy_bucket").agg(
        F.count(F.lit(1)).alias("dormant_customers"),
        money("total_spend").alias("historic_total_spend"),
        avg2("avg_order_value").alias("avg_last_order_value"),
        avg_int("total_orders").alias("avg_lifetime_orders"),
    )


# ---- 5. Cohorts ----------------------------------------------------------------------

def cohort_sizes(mart: DataFrame) -> DataFrame:
    return mart.groupBy("cohort_month", "cohort_year").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.sum("repeat_purchase_flag").cast("bigint").alias("repeat_buyers"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
        avg2("total_spend").alias("avg_ltv"),
        avg2("avg_days_between_orders", 1).alias("avg_days_between_orders"),
        money("total_spend").alias("cohort_total_revenue"),
    )


WORD = 62  # months in one word of a bitmap


def active_months(fact: DataFrame) -> DataFrame:
    """One bitmap of the months with a purchase per customer, and the first such month, in one aggregation.

    Bit i of the words (``WORD`` bits each) is month ``base_month`` + i; the number of words follows from the months
    that the fact covers.  A word is a bigint that rows are OR-ed into: a hash aggregation, combined
    map-side, so a customer with a third of all orders is one row per task.
    """
    rows = fact.filter(F.col("customer_unique_id").isNotNull() & F.col("order_purchase_timestamp").isNotNull()) \
        .select("customer_unique_id", month_index("order_purchase_timestamp").alias("_m"))
    lo, hi = rows.agg(F.min("_m"), F.max("_m")).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    rows = rows.withColumn("_i", F.col("_m") - F.lit(lo))
    words = [F.bit_or(F.expr(f"CASE WHEN _i DIV {WORD} = {k} THEN shiftleft(1L, CAST(_i % {WORD} AS INT)) ELSE 0L END")).alias(f"_w{k}")
             for k in range((hi - lo) // WORD + 1)]
    g = rows.groupBy("customer_unique_id").agg(F.min("_m").cast("int").alias("first_month"), *words)
    return g.select("customer_unique_id", "first_month", F.lit(lo).alias("base_month"),
                    F.array(*[f"_w{k}" for k in range(len(words))]).alias("months"))


def is_active(month: Column) -> Column:
    """1 if the bitmap ``months`` has the month (an index as ``first_month``), else 0; months it does not cover are 0."""
    i = month - F.col("base_month")
    word = F.when((i >= 0) & (i < F.size("months") * WORD), F.get("months", F.floor(i / WORD).cast("int")))
    return F.coalesce(F.call_function("shiftright", word, F.pmod(i, F.lit(WORD)).cast("int")).bitwiseAND(F.lit(1)), F.lit(0)).cast("bigint")


def month_label(index) -> Column:
    """yyyy-MM of a month index (12 * year + month)."""
    m = F.col(index) - 1
    return F.format_string("%04d-%02d", F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"))


def cohort_activity(months: DataFrame) -> DataFrame:
    """Active customers per cohort and period: one aggregation of the customers' bitmaps."""
    lo, hi = RETENTION_PERIODS
    g = months.groupBy("first_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[F.sum(is_active(F.col("first_month") + p)).alias(f"_p{p}") for p in range(lo, hi + 1)])
    pairs = ", ".join(f"{p}, _p{p}" for p in range(lo, hi + 1))
    long = g.select(month_label("first_month").alias("cohort_month"), "cohort_size",
                    F.expr(f"stack({hi - lo + 1}, {pairs}) AS (period_num, active_customers)")).filter("active_customers > 0")
    return long.withColumn("retention_pct", pct(F.col("active_customers"), F.col("cohort_size")))


def cohort_retention_matrix(months: DataFrame) -> DataFrame:
    a = cohort_activity(months)
    label = F.when(F.col("period_num") == 0, F.lit("Month 0 (acquisition)")).otherwise(
        F.concat(F.lit("Month "), F.col("period_num").cast("string")))
    return a.select("cohort_month", "cohort_size", "period_num", "active_customers", "retention_pct",
                    label.alias("period_label"))


def retention_by_period(months: DataFrame) -> DataFrame:
    a = cohort_activity(months)
    return a.groupBy("period_num").agg(
        F.round(F.avg("retention_pct"), 2).alias("avg_retention_pct"),
        F.round(F.min("retention_pct"), 2).alias("min_retention_pct"),
        F.round(F.max("retention_pct"), 2).alias("max_retention_pct"),
        F.countDistinct("cohort_month").alias("cohorts_measured"),
    )


# ---- 6. Retention trends ------------------------------------------------------------------

def new_vs_returning(months: DataFrame) -> DataFrame:
    covered = F.sequence(F.col("first_month"), F.col("base_month") + F.size("months") * WORD - 1)
    cm = months.select("first_month", F.explode(F.filter(covered, lambda m: is_active(m) == 1)).alias("_m"))
    is_new = F.col("_m") == F.col("first_month")
    g = cm.groupBy(month_label("_m").alias("order_month")).agg(
        count_if(is_new).alias("new_customers"),
        count_if(~is_new).alias("returning_customers"),
        F.count(F.lit(1)).alias("total_active_customers"),
    )
    return g.withColumn("returning_customer_pct", pct(F.col("returning_customers"), F.col("total_active_customers")))


def repeat_rate_trend(mart: DataFrame) -> DataFrame:
    g = mart.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.sum("repeat_purchase_flag").cast("bigint").alias("repeat_buyers"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
    )
    w = Window.orderBy("cohort_month")
    prev = F.lag("repeat_rate_pct", 1).over(w)
    return g.select(
        "cohort_month", "cohort_size", "repeat_buyers", "repeat_rate_pct",
        F.round(F.avg("repeat_rate_pct").over(w.rowsBetween(-2, 0)), 2).alias("rolling_3mo_avg_repeat_rate"),
        prev.alias("prev_month_repeat_rate"),
        F.round(F.col("repeat_rate_pct") - prev, 2).alias("mom_change_pct_points"),
    )


# ---- 7. Delivery risk ------------------------------------------------------------------------

def delay_review_impact(mart: DataFrame) -> DataFrame:
    m = mart.filter(F.col("delayed_order_ratio").isNotNull())
    return m.withColumn("delay_bucket", _rules(DELAY_RATIO_BUCKETS, DELAY_RATIO_DEFAULT)).groupBy("delay_bucket").agg(
        F.count(F.lit(1)).alias("customers"),
        avg2("avg_customer_review_score").alias("avg_review_score"),
        avg2("total_spend").alias("avg_lifetime_spend"),
        avg_int("total_orders").alias("avg_orders"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
        avg2("avg_delivery_delay", 1).alias("avg_delay_days"),
    )


def high_value_categories(mart: DataFrame) -> DataFrame:
    cancel = F.col("cancelled_orders") * dec("1.0") / nullif("total_orders", 0)
    return mart.withColumn("hv_category", _rules(HIGH_VALUE_BUCKETS, HIGH_VALUE_DEFAULT)).groupBy("hv_category").agg(
        F.count(F.lit(1)).alias("customers"),
        avg2("total_spend").alias("avg_lifetime_spend"),
        avg2("avg_order_value").alias("avg_order_value"),
        F.round(F.avg(cancel) * F.lit(100), 2).alias("avg_cancellation_pct"),
        avg2("avg_customer_review_score").alias("avg_review_score"),
        avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_pct"),
    )


def delay_retention(mart: DataFrame) -> DataFrame:
    m = mart.filter(F.col("avg_delivery_delay").isNotNull())
    start = F.round(F.col("avg_delivery_delay") / F.lit(5), 0) * F.lit(5)
    return m.withColumn("delay_day_bucket_start", start).groupBy("delay_day_bucket_start").agg(
        F.count(F.lit(1)).alias("customers"),
        avg2("avg_customer_review_score").alias("avg_review"),
        pct(F.sum("repeat_purchase_flag"), F.count(F.lit(1))).alias("repeat_rate_pct"),
        avg2("total_spend").alias("avg_ltv"),
    )


# ---- 8. Temporal trends ---------------------------------------------------------------------

def monthly_fact(fact: DataFrame) -> DataFrame:
    """Per purchase month; the fact has one row per order, so COUNT = COUNT(DISTINCT order_id)."""
    f = fact.filter(F.col("order_purchase_timestamp").isNotNull())
    return f.groupBy(
        year_month("order_purchase_timestamp").alias("order_month"),
        F.year("order_purchase_timestamp").alias("order_year"),
        F.month("order_purchase_timestamp").alias("order_month_num"),
    ).agg(
        F.count("order_id").alias("order_count"),
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        money("total_payment_value").alias("revenue"),
        money("total_order_value").alias("items_revenue"),
        money("total_freight_value").alias("freight_revenue"),
        avg2("total_payment_value").alias("avg_order_value"),
        avg2("avg_review_score").alias("avg_review_score"),
        F.sum("is_delayed_delivery").cast("bigint").alias("delayed_orders"),
        pct(F.sum("is_delayed_delivery"), F.count("order_id")).alias("delay_rate_pct"),
    )


def _trend_columns(revenue: str = "revenue"):
    w = Window.orderBy("order_month")
    prev = F.lag(revenue, 1).over(w)
    return {
        "prev": prev.alias("prev_month_revenue"),
        "change": F.round(F.col(revenue) - prev, 2).alias("mom_revenue_change"),
        "growth": pct(F.col(revenue) - prev, prev).alias("mom_growth_pct"),
        "rolling": F.round(F.avg(revenue).over(w.rowsBetween(-2, 0)), 2),
        "ytd": F.round(F.sum(revenue).over(
            Window.partitionBy("order_year").orderBy("order_month").rowsBetween(Window.unboundedPreceding, 0)), 2),
    }


def monthly_trend(fact: DataFrame) -> DataFrame:
    m = monthly_fact(fact)
    t = _trend_columns()
    return m.select(
        "order_month", F.col("order_count").alias("orders"), "revenue",
        F.col("unique_customers").alias("active_customers"), F.col("avg_review_score").alias("avg_review"),
        t["prev"], t["change"], t["growth"], t["rolling"].alias("rolling_3mo_avg_revenue"),
        t["ytd"].alias("ytd_revenue"),
    )


def weekday_distribution(fact: DataFrame) -> DataFrame:
    g = fact.filter(F.col("order_day_of_week").isNotNull()).groupBy("order_day_of_week").agg(
        F.count("order_id").alias("total_orders"),
        money("total_payment_value").alias("total_revenue"),
        avg2("total_payment_value").alias("avg_order_value"),
    )
    return g.withColumn("orders_share_pct", share_of_total("total_orders")).orderBy(
        field_position("order_day_of_week", WEEKDAYS))


# ---- 9. Geography ----------------------------------------------------------------------------

def state_metrics(mart: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return mart.filter(F.col("customer_state").isNotNull()).groupBy("customer_state").agg(
        n.alias("total_customers"),
        money("total_spend").alias("total_revenue"),
        avg2("total_spend").alias("avg_customer_ltv"),
        avg2("avg_order_value").alias("avg_order_value"),
        pct(F.sum("repeat_purchase_flag"), n).alias("repeat_rate_pct"),
        stage_pct("ACTIVE").alias("active_pct"),
        stage_pct("DORMANT").alias("dormant_pct"),
        avg2("avg_customer_review_score").alias("avg_review"),
    )


def state_ranking(mart: DataFrame, top: int = 15) -> DataFrame:
    s = state_metrics(mart)
    s = s.select(
        "customer_state", "total_customers",
        F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc())).alias("revenue_rank"),
        "total_revenue", share_of_total("total_revenue").alias("revenue_share_pct"),
        "avg_customer_ltv", "avg_order_value", "repeat_rate_pct", "active_pct", "dormant_pct", "avg_review",
    )
    # the report is a top-k: the limit is the feature (shares are over ALL states)
    return s.orderBy(F.col("total_revenue").desc(), F.col("customer_state")).limit(top)


# ---- 10. Buyer types ----------------------------------------------------------------------------

def buyer_type_comparison(mart: DataFrame) -> DataFrame:
    g = mart.groupBy("repeat_purchase_flag").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_spend").alias("_rev"),
        avg2("total_spend").alias("avg_ltv"),
        avg2("avg_order_value").alias("avg_order_value"),
        avg_int("total_orders").alias("avg_orders"),
        avg_int("customer_lifetime_days", 0).alias("avg_lifetime_days"),
        avg2("avg_customer_review_score").alias("avg_review_score"),
        avg_pct_of_ratio("delayed_order_ratio").alias("avg_delay_pct"),
        avg_int("total_categories_purchased").alias("avg_categories_explored"),
    )
    return g.select(
        F.when(F.col("repeat_purchase_flag") == 1, F.lit(BUYER_TYPES[0])).otherwise(F.lit(BUYER_TYPES[1]))
        .alias("buyer_type"),
        "customers", share_of_total("customers").alias("customer_share_pct"),
        F.round("_rev", 2).alias("total_revenue"), share_of_total("_rev").alias("revenue_share_pct"),
        "avg_ltv", "avg_order_value", "avg_orders", "avg_lifetime_days", "avg_review_score", "avg_delay_pct",
        "avg_categories_explored",
    )


def repurchase_interval(mart: DataFrame) -> DataFrame:
    m = mart.filter((F.col("repeat_purchase_flag") == 1) & F.col("avg_days_between_orders").isNotNull())
    return m.withColumn("repurchase_interval", _rules(REPURCHASE_BUCKETS, REPURCHASE_DEFAULT)) \
        .groupBy("repurchase_interval").agg(
            F.count(F.lit(1)).alias("repeat_customers"),
            avg2("total_spend").alias("avg_ltv"),
            avg_int("total_orders").alias("avg_total_orders"),
            avg2("avg_customer_review_score").alias("avg_review"),
        )


# ---- 11. Segment x lifecycle ---------------------------------------------------------------------

def segment_lifecycle_matrix(mart: DataFrame) -> DataFrame:
    g = mart.groupBy("segment_label", "lifecycle_stage").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("total_spend").alias("_rev"),
        avg2("avg_order_value").alias("avg_order_value"),
        avg_int("rfm_score").alias("avg_rfm_score"),
    )
    return g.select("segment_label", "lifecycle_stage", "customer_count", F.round("_rev", 2).alias("revenue"),
                    "avg_order_value", "avg_rfm_score", share_of_total("_rev").alias("revenue_pct_of_total"))


def segment_top_categories(mart: DataFrame, k: int = 3) -> DataFrame:
    g = mart.filter(F.col("preferred_category").isNotNull()).groupBy("segment_label", "preferred_category").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("total_spend").alias("revenue"))
    top = top_k_per_group(g, "segment_label", [F.col("revenue").desc(), F.col("preferred_category")], k)
    return top.select("segment_label", "preferred_category", "customer_count",
                      F.round("revenue", 2).alias("segment_category_revenue"))


# ---- mart distributions (stage 3 preview) -----------------------------------------------------------

def mart_distributions(mart: DataFrame) -> DataFrame:
    """Lifecycle and segment shares, rfm score histogram and cohort sizes in one long table."""
    def share(col, name):
        g = mart.groupBy(col).agg(F.count(F.lit(1)).alias("customers"))
        return g.select(F.lit(name).alias("distribution"), F.col(col).cast("string").alias("value"),
                        "customers", share_of_total("customers").alias("pct"))

    def hist(col, name):
        g = mart.groupBy(col).agg(F.count(F.lit(1)).alias("customers"))
        return g.select(F.lit(name).alias("distribution"), F.col(col).cast("string").alias("value"),
                        "customers", F.lit(None).cast("decimal(38,2)").alias("pct"))

    return share("lifecycle_stage", "lifecycle_stage").unionByName(share("segment_label", "segment_label")) \
        .unionByName(hist("rfm_score", "rfm_score")).unionByName(hist("cohort_month", "cohort_month"))
