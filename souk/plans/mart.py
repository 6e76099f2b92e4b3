"""Customer feature mart: one row per customer_unique_id, 48 data columns.

Plan shape:
* ONE ``groupBy(customer_unique_id)`` computes the 26 measures and the
  recency-window counts - partial aggregation map-side, so a customer
  with a third of all orders is reduced before the shuffle;
* the last known location is read from the orders at the customer's last order date,
  which that aggregation has found already (no struct buffer, no sort aggregate);
* preferred category / weekday: ``dominant`` (two more aggregations);
* r/f/m scores: three NTILE(5) as comparisons with the ends of the tiles, which are found from
  counts of values over the (materialised) aggregate - no window over it;
* the reference date is a single scalar (MAX over the fact).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import avg_dec, count_if, days_between, dec, flag, nullif, ratio, ts_lit, year_month
from ..operators.modes import dominant, latest_by
from ..operators.ranking import SortKey
from ..operators.selection import tiles

MART_COLUMNS = [
    "customer_unique_id", "customer_city", "customer_state", "total_orders", "total_spend",
    "avg_order_value", "min_order_value", "max_order_value", "first_order_date", "last_order_date",
    "customer_lifetime_days", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
    "rfm_score", "rfm_label", "lifecycle_stage", "segment_label", "cohort_month", "cohort_year",
    "repeat_purchase_flag", "is_one_time_buyer", "avg_days_between_orders", "days_since_first_order",
    "orders_last_30d", "orders_last_60d", "orders_last_90d", "orders_last_180d", "avg_delivery_delay",
    "delayed_order_ratio", "multi_item_ratio", "multi_payment_ratio", "avg_customer_review_score",
    "avg_items_per_order", "avg_freight_per_order", "avg_sellers_per_order", "avg_products_per_order",
    "total_categories_purchased", "high_value_order_ratio", "total_reviews_given", "delivered_orders",
    "cancelled_orders", "shipped_orders", "preferred_category", "preferred_day_of_week",
]

MONEY = "decimal(18,2)"
RATIO = "decimal(10,4)"
RECENCY_WINDOWS = (30, 60, 90, 180)
_MART_TYPES = {
    "timestamp_ntz": ["first_order_date", "last_order_date"],
    "decimal(18,1)": ["avg_days_between_orders"],
    RATIO: ["delayed_order_ratio", "multi_item_ratio", "multi_payment_ratio", "high_value_order_ratio"],
    MONEY: ["total_spend", "avg_order_value", "min_order_value", "max_order_value", "monetary", "avg_delivery_delay",
            "avg_customer_review_score", "avg_items_per_order", "avg_freight_per_order", "avg_sellers_per_order",
            "avg_products_per_order"],
    "int": ["customer_lifetime_days", "recency_days", "r_score", "f_score", "m_score", "rfm_score", "cohort_year",
            "repeat_purchase_flag", "is_one_time_buyer", "days_since_first_order"],
    "bigint": ["total_orders", "frequency", "total_categories_purchased", "total_reviews_given", "delivered_orders",
               "cancelled_orders", "shipped_orders", *(f"orders_last_{d}d" for d in RECENCY_WINDOWS)],
}
#: declared schema: column -> type, in order (text unless named above)
MART_SCHEMA = {c: next((kind for kind, cols in _MART_TYPES.items() if c in cols), "string") for c in MART_COLUMNS}

# ---- fixed values (must equal the reference's literals) ----------------------
# segment rules, first match wins: (label, condition on r/f/m scores and total_orders)
SEGMENT_RULES = [
    ("champions", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("cannot_lose", "r_score <= 2 AND m_score >= 4"),
    ("loyal", "f_score >= 4 AND m_score >= 3 AND r_score >= 3"),
    ("high_value", "m_score = 5 AND r_score >= 3"),
    ("new_customer", "r_score >= 4 AND f_score = 1 AND total_orders = 1"),
    ("potential_loyalist", "r_score >= 3 AND f_score BETWEEN 2 AND 3"),
    ("churn_risk", "r_score = 2 AND f_score >= 2"),
    ("at_risk", "r_score <= 2 AND f_score >= 3"),
    ("lost", "r_score = 1 AND f_score = 1 AND m_score = 1"),
    ("hibernating", "r_score <= 2 AND f_score <= 2"),
]
SEGMENT_DEFAULT = "others"
LIFECYCLE_RULES = [("ACTIVE", "recency_days <= 30"), ("AT_RISK", "recency_days BETWEEN 31 AND 60")]
LIFECYCLE_DEFAULT = "DORMANT"
STATUS_DELIVERED, STATUS_CANCELLED, STATUS_SHIPPED = "delivered", "cancelled", "shipped"
# -----------------------------------------------------------------------------


def case_sql(rules, default) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{label}'" for label, c in rules) + f" ELSE '{default}' END"


def reference_date(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_purchase_timestamp").isNotNull()).agg(
        F.max("order_purchase_timestamp").alias("ref_date")
    )


def category_counts(fact: DataFrame) -> DataFrame:
    """Distinct dominant categories per customer."""
    pairs = fact.filter(F.col("customer_unique_id").isNotNull() & F.col("dominant_category").isNotNull()).select(
        "customer_unique_id", "dominant_category").distinct()
    return pairs.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("total_categories_purchased"))


def customer_agg(fact: DataFrame, ref_date) -> DataFrame:
    """Per-customer measures and recency windows in one aggregation (the last location is one of its own).

    Distinct categories are counted beside it from narrow rows and joined, so that the wide
    buffers of the other measures are shuffled once, not per category and again.

    ``total_orders`` counts rows: the fact has exactly one row per order_id,
    so it equals COUNT(DISTINCT order_id) without a distinct aggregation.
    """
    ref = ts_lit(ref_date)
    orders = F.count("order_id")
    age = days_between("order_purchase_timestamp", ref)
    aggs = [
        orders.alias("total_orders"),
        F.round(F.sum("total_payment_value"), 2).cast(MONEY).alias("total_spend"),
        F.round(F.avg("total_payment_value"), 2).cast(MONEY).alias("avg_order_value"),
        F.round(F.min("total_payment_value"), 2).cast(MONEY).alias("min_order_value"),
        F.round(F.max("total_payment_value"), 2).cast(MONEY).alias("max_order_value"),
        days_between(F.max("order_purchase_timestamp"), ref).alias("recency_days"),
        F.min("order_purchase_timestamp").alias("first_order_date"),
        F.max("order_purchase_timestamp").alias("last_order_date"),
        days_between(F.min("order_purchase_timestamp"), F.max("order_purchase_timestamp")).alias("customer_lifetime_days"),
        avg_dec("delivery_delay_days", 2, in_scale=0).cast("decimal(18,2)").alias("avg_delivery_delay"),
        ratio(F.sum("is_delayed_delivery"), orders).cast(RATIO).alias("delayed_order_ratio"),
        ratio(F.sum("is_multi_item_order"), orders).cast(RATIO).alias("multi_item_ratio"),
        ratio(F.sum("is_multi_payment"), orders).cast(RATIO).alias("multi_payment_ratio"),
        F.round(F.avg("avg_review_score"), 2).cast("decimal(18,2)").alias("avg_customer_review_score"),
        avg_dec("total_items", 2, in_scale=0).cast("decimal(18,2)").alias("avg_items_per_order"),
        F.round(F.avg("total_freight_value"), 2).cast(MONEY).alias("avg_freight_per_order"),
        avg_dec("unique_sellers", 2, in_scale=0).cast("decimal(18,2)").alias("avg_sellers_per_order"),
        avg_dec("unique_products", 2, in_scale=0).cast("decimal(18,2)").alias("avg_products_per_order"),
        count_if(F.col("order_status") == STATUS_DELIVERED).alias("delivered_orders"),
        count_if(F.col("order_status") == STATUS_CANCELLED).alias("cancelled_orders"),
        count_if(F.col("order_status") == STATUS_SHIPPED).alias("shipped_orders"),
        ratio(F.sum("is_high_value_order"), orders).cast(RATIO).alias("high_value_order_ratio"),
        F.sum("review_count").cast("bigint").alias("total_reviews_given"),
    ]
    aggs += [count_if(age <= d).alias(f"orders_last_{d}d") for d in RECENCY_WINDOWS]
    g = fact.filter(F.col("customer_unique_id").isNotNull()).groupBy("customer_unique_id").agg(*aggs)
    names = g.columns
    names.insert(names.index("delivered_orders"), "total_categories_purchased")
    g = g.join(category_counts(fact), "customer_unique_id", "left").withColumn(
        "total_categories_purchased", F.coalesce("total_categories_purchased", F.lit(0).cast("bigint"))).select(*names)
    return g.withColumn("frequency", F.col("total_orders")).withColumn("monetary", F.col("total_spend"))


def last_location(fact: DataFrame, agg: DataFrame) -> DataFrame:
    """City/state of the latest order (order_id breaks timestamp ties).

    ``agg`` (one row per customer, bucketed) holds the last order date, so the fact is joined with it and
    only the orders at that date go on; of several, the greatest order_id is the latest.
    """
    rows = fact.filter(F.col("customer_unique_id").isNotNull()).select(
        "customer_unique_id", "order_purchase_timestamp", "order_id", "customer_city", "customer_state")
    return latest_by(rows, "customer_unique_id", "order_purchase_timestamp", ["order_id"], ["customer_city", "customer_state"],
                     agg.select("customer_unique_id", F.col("last_order_date").alias("order_purchase_timestamp")))


def preferred(fact: DataFrame, value: str, name: str) -> DataFrame:
    rows = fact.filter(F.col("customer_unique_id").isNotNull() & F.col(value).isNotNull())
    return dominant(rows, "customer_unique_id", value, name)


RFM_KEYS = {"r_score": SortKey("recency_days", True), "f_score": SortKey("frequency"), "m_score": SortKey("monetary")}


def with_rfm(agg: DataFrame, k: int = 5) -> DataFrame:
    """r/f/m NTILE(k) over all customers, ties broken by customer id: one projection, after the ends of the
    tiles have been found from counts of the three values."""
    scores = tiles(agg, RFM_KEYS, "customer_unique_id", k)
    scored = agg.select("*", *[c.alias(name) for name, c in scores.items()])
    return scored.select(
        "*", (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"),
        F.concat(*[F.col(name).cast("string") for name in RFM_KEYS]).alias("rfm_label"),
    )


def assemble_mart(scored: DataFrame, loc: DataFrame, pref_cat: DataFrame, pref_day: DataFrame, ref_date) -> DataFrame:
    ref = ts_lit(ref_date)
    m = (
        scored.join(loc, "customer_unique_id", "left")
        .join(pref_cat, "customer_unique_id", "left")
        .join(pref_day, "customer_unique_id", "left")
    )
    orders = F.col("total_orders")
    gap = F.when(
        (orders > 1) & (F.col("customer_lifetime_days") > 0),
        F.round(F.col("customer_lifetime_days") * dec("1.0") / nullif(orders - 1, 0), 1),
    ).cast("decimal(18,1)")
    m = m.select(
        "*",
        F.expr(case_sql(LIFECYCLE_RULES, LIFECYCLE_DEFAULT)).alias("lifecycle_stage"),
        F.expr(case_sql(SEGMENT_RULES, SEGMENT_DEFAULT)).alias("segment_label"),
        year_month("first_order_date").alias("cohort_month"),
        F.year("first_order_date").alias("cohort_year"),
        flag(orders > 1).alias("repeat_purchase_flag"),
        flag(orders == 1).alias("is_one_time_buyer"),
        gap.alias("avg_days_between_orders"),
        days_between("first_order_date", ref).alias("days_since_first_order"),
    )
    return m.select(*MART_COLUMNS)


def build_mart(fact: DataFrame, materialize=None, parallel=None) -> DataFrame:
    """``materialize(df, name) -> df`` cuts lineage (written table); identity when None.
    ``parallel(items, fn) -> dict`` runs independent steps side by side."""
    materialize = materialize or (lambda df, name: df)
    ref_date = reference_date(fact).first()[0]
    steps = {
        "customer_agg": lambda: materialize(customer_agg(fact, ref_date), "customer_agg"),
        "customer_preferred_cat": lambda: materialize(
            preferred(fact, "dominant_category", "preferred_category"), "customer_preferred_cat"),
        "customer_preferred_day": lambda: materialize(
            preferred(fact, "order_day_of_week", "preferred_day_of_week"), "customer_preferred_day"),
    }
    done = parallel(list(steps), lambda n: steps[n]()) if parallel else {n: f() for n, f in steps.items()}
    agg = done["customer_agg"]
    return assemble_mart(with_rfm(agg), last_location(fact, agg), done["customer_preferred_cat"],
                         done["customer_preferred_day"], ref_date)
