"""Order fact: one row per order, 34 data columns (+ audit column when written).

Plan shape: every per-order input (items, dominant category, dominant seller
state, payments, reviews) is an aggregation keyed by ``order_id``, and so is
the deduplicated order base, so the left joins between them reuse one hash
partitioning on ``order_id``.  Customers are joined first (one shuffle of the
order rows by ``customer_id`` while they are narrow); the category translation is a
per-category table that AQE broadcasts at runtime when its measured size is
under the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import avg_dec, days_between, dec, flag, nullif, weekday_name
from ..operators.integrity import dedupe, ri_check
from ..operators.modes import dominant
from ..operators.selection import percentile_disc

FACT_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "order_status", "order_purchase_timestamp",
    "order_delivered_customer_date", "customer_city", "customer_state", "total_order_value",
    "total_freight_value", "total_payment_value", "avg_payment_installments", "total_items",
    "unique_products", "dominant_category", "category_english", "unique_sellers",
    "dominant_seller_state", "avg_review_score", "review_count", "order_month", "order_year",
    "order_day_of_week", "delivery_delay_days", "processing_time_days", "is_delayed_delivery",
    "is_high_value_order", "is_multi_payment", "is_multi_item_order", "timestamp_sequence_flag",
    "ri_missing_customer", "ri_missing_items", "ri_missing_payment", "ri_missing_review",
]

MONEY = "decimal(18,2)"
_FACT_TYPES = {
    "timestamp_ntz": ["order_purchase_timestamp", "order_delivered_customer_date"],
    MONEY: ["total_order_value", "total_freight_value", "total_payment_value", "avg_payment_installments", "avg_review_score"],
    "bigint": ["total_items", "unique_products", "unique_sellers", "review_count"],
    "int": ["order_month", "order_year", "delivery_delay_days", "processing_time_days", "is_delayed_delivery",
            "is_high_value_order", "is_multi_payment", "is_multi_item_order", "timestamp_sequence_flag",
            "ri_missing_customer", "ri_missing_items", "ri_missing_payment", "ri_missing_review"],
}
#: declared schema: column -> type, in order (text unless named above)
FACT_SCHEMA = {c: next((kind for kind, cols in _FACT_TYPES.items() if c in cols), "string") for c in FACT_COLUMNS}


# ---- one-row-per-key dimension views ------------------------------------------

def customers_dim(customers: DataFrame) -> DataFrame:
    return dedupe(customers, "customer_id", ["duplicate_flag"],
                  ["customer_id", "customer_unique_id", "customer_city", "customer_state"], "duplicate_flag")


def sellers_dim(sellers: DataFrame) -> DataFrame:
    return dedupe(sellers, "seller_id", ["duplicate_flag"], ["seller_id", "seller_state", "seller_city"],
                  "duplicate_flag")


def products_dim(products: DataFrame) -> DataFrame:
    return dedupe(products, "product_id", ["duplicate_flag"], ["product_id", "product_category_name"],
                  "duplicate_flag")


def translation_dim(translation: DataFrame) -> DataFrame:
    return dedupe(translation, "product_category_name", ["duplicate_flag"],
                  ["product_category_name", "product_category_name_english"], "duplicate_flag")


def orders_base(orders: DataFrame) -> DataFrame:
    return dedupe(orders, "order_id", ["duplicate_flag"], orders.columns, "duplicate_flag")


# ---- per-order aggregates -------------------------------------------------------

HOT_ORDER = 1_000_000  # rows of one order that a task may hold
HOT_BUCKETS = 1 << 16


def hot_orders(rows: DataFrame, limit: int = HOT_ORDER) -> DataFrame:
    """Orders with more than ``limit`` rows; there are at most rows / limit of them.

    Rows are counted per bucket of orders first, which shuffles at most ``HOT_BUCKETS`` rows a task; orders are counted
    only in buckets with more than ``limit`` rows.
    """
    known = rows.filter(F.col("order_id").isNotNull()).select("order_id", F.pmod(F.xxhash64("order_id"), F.lit(HOT_BUCKETS)).alias("_b"))
    full = known.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("_b")
    return known.join(F.broadcast(full), "_b", "left_semi").groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("order_id")


def _per_order(rows: DataFrame, aggregate, hot: DataFrame | None = None, dealt: bool = False, of_dealt=None) -> DataFrame:
    """``aggregate(rows)``, one row per order, from rows that are dealt by order once, so that its steps shuffle nothing again.

    Only if ``dealt``; the rows of ``hot`` orders are not dealt and go through the steps as they are, which combine
    before they shuffle, so no task gets all rows of such an order.  ``of_dealt`` may be the same aggregate for dealt rows.
    """
    if not dealt:
        return aggregate(rows)
    if hot is None:
        return (of_dealt or aggregate)(rows.repartition("order_id"))
    ordinary = rows.join(F.broadcast(hot), "order_id", "left_anti").repartition("order_id")
    return (of_dealt or aggregate)(ordinary).unionByName(aggregate(rows.join(F.broadcast(hot), "order_id", "left_semi")))


def _distinct(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct rows of columns that hold the key of ``duplicate_flag``: rows alone with their key are distinct already."""
    if "duplicate_flag" not in rows.columns:
        return rows.select(*cols).distinct()
    alone = rows.filter(F.col("duplicate_flag") == 0).select(*cols)
    return alone.unionByName(rows.filter(F.col("duplicate_flag") != 0).select(*cols).distinct())


def agg_order_items(items: DataFrame, hot: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    lines = items.filter(F.col("order_id").isNotNull()).select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "is_free_item")
    return _per_order(lines, _item_measures, hot, dealt, lambda rows: _item_measures(rows, _set_size))


def _set_size(column: str) -> Column:
    """Distinct values without NULL of rows that are dealt by group, from one set per group: two ``countDistinct`` would be
    planned with three copies of each row and shuffled again."""
    return F.size(F.collect_set(column)).cast("bigint")


def _item_measures(lines: DataFrame, distinct_count=F.countDistinct) -> DataFrame:
    lines = lines.distinct()
    return lines.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items"),
        distinct_count("product_id").alias("unique_products"),
        distinct_count("seller_id").alias("unique_sellers"),
        F.round(F.sum("price"), 2).cast(MONEY).alias("total_item_value"),
        F.round(F.sum(F.coalesce(F.col("freight_value"), dec("0.00"))), 2).cast(MONEY).alias("total_freight_value"),
        F.sum("is_free_item").cast("bigint").alias("free_item_count"),
    )


def agg_dominant_category(items: DataFrame, products: DataFrame, dim: DataFrame | None = None, hot: DataFrame | None = None,
                          dealt: bool = False) -> DataFrame:
    dim = dim if dim is not None else products_dim(products)
    named = items.filter(F.col("order_id").isNotNull()).select("order_id", "product_id").join(dim, "product_id", "left").select(
        "order_id", "product_id", F.coalesce(F.col("product_category_name"), F.lit("uncategorised")).alias("category_name"))
    return _per_order(named, lambda rows: dominant(rows.distinct(), "order_id", "category_name", "dominant_category"), hot, dealt)


def agg_dominant_seller_state(items: DataFrame, sellers: DataFrame, dim: DataFrame | None = None, hot: DataFrame | None = None,
                              dealt: bool = False) -> DataFrame:
    dim = dim if dim is not None else sellers_dim(sellers)
    named = items.filter(F.col("order_id").isNotNull()).select("order_id", "seller_id").join(dim, "seller_id", "left").select(
        "order_id", "seller_id", F.coalesce(F.col("seller_state"), F.lit("unknown")).alias("seller_state"))
    best = _per_order(named, lambda rows: dominant(rows.distinct(), "order_id", "seller_state", "dominant_seller_state"), hot, dealt)
    return best.withColumn("dominant_seller_state", nullif("dominant_seller_state", "unknown"))


def agg_order_payments(payments: DataFrame, hot: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    rows = _distinct(payments.filter(F.col("order_id").isNotNull()), [
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"])
    return _per_order(rows, _payment_measures, hot, dealt)


def _payment_measures(rows: DataFrame) -> DataFrame:
    return rows.groupBy("order_id").agg(
        F.round(F.sum("payment_value"), 2).cast(MONEY).alias("total_payment_value"),
        avg_dec("payment_installments", 2, in_scale=0).cast("decimal(18,2)").alias("avg_payment_installments"),
        F.count(F.lit(1)).alias("payment_row_count"),
        F.countDistinct("payment_type").alias("distinct_payment_types"),
    )


def agg_order_reviews(reviews: DataFrame) -> DataFrame:
    rows = _distinct(reviews.filter(F.col("order_id").isNotNull()), ["order_id", "review_id", "review_score"])
    return rows.groupBy("order_id").agg(
        avg_dec("review_score", 2, in_scale=0).cast("decimal(18,2)").alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def high_value_threshold(payment_agg: DataFrame) -> DataFrame:
    """75th percentile of order payment totals: smallest value with CUME_DIST >= 0.75 (1 row)."""
    vals = payment_agg.select("total_payment_value").filter(F.col("total_payment_value").isNotNull())
    return percentile_disc(vals, "total_payment_value", 0.75).select(F.col("total_payment_value").alias("p75_threshold"))


# ---- the fact ------------------------------------------------------------------

DIMENSIONS = {  # name -> (cleaned table, key)
    "dim_customers": ("customers", "customer_id"),
    "dim_sellers": ("sellers", "seller_id"),
    "dim_products": ("products", "product_id"),
    "dim_translation": ("category_translation", "product_category_name"),
}


def dimension_views(cleaned: dict[str, DataFrame]) -> dict:
    """One-row-per-key dimension builders (the reference's deduplicated views)."""
    fns = {"dim_customers": customers_dim, "dim_sellers": sellers_dim, "dim_products": products_dim,
           "dim_translation": translation_dim}
    return {name: (lambda fn=fns[name], t=table: fn(cleaned[t])) for name, (table, _) in DIMENSIONS.items()}


def order_aggregates(cleaned: dict[str, DataFrame], dims: dict[str, DataFrame] | None = None,
                     hot: dict[str, DataFrame | None] | None = None) -> dict[str, DataFrame]:
    """The five per-order inputs of the fact (the reference's agg_* tables).  Where ``hot`` has the hot orders of a
    table (None: it has none), the others are dealt by order."""
    dims, hot = dims or {}, hot or {}
    of = lambda t: {"hot": hot.get(t), "dealt": t in hot}
    return {
        "agg_order_items": lambda: agg_order_items(cleaned["order_items"], **of("order_items")),
        "agg_order_dominant_category": lambda: agg_dominant_category(
            cleaned["order_items"], cleaned.get("products"), dims.get("dim_products"), **of("order_items")),
        "agg_order_dominant_seller": lambda: agg_dominant_seller_state(
            cleaned["order_items"], cleaned.get("sellers"), dims.get("dim_sellers"), **of("order_items")),
        "agg_order_payments": lambda: agg_order_payments(cleaned["payments"], **of("payments")),
        "agg_order_reviews": lambda: agg_order_reviews(cleaned["reviews"]),
    }


def with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with its customer; ``_cust`` is NULL where there is none."""
    return orders_base(orders).alias("o").join(customers.withColumn("_cust", F.lit(1)).alias("c"), "customer_id", "left")


def purchases(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer and time of every order, as in the fact: its other inputs have one row per order and change neither."""
    return with_customers(orders, customers).select("customer_unique_id", "order_purchase_timestamp")


def build_fact(cleaned: dict[str, DataFrame], threshold: DataFrame | None = None,
               aggs: dict[str, DataFrame] | None = None, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """``aggs`` / ``dims`` may hold the per-order aggregates and the dimensions already written as tables."""
    aggs = aggs or {name: build() for name, build in order_aggregates(cleaned).items()}
    dims = dims or {}
    customers = dims.get("dim_customers")
    customers = customers if customers is not None else customers_dim(cleaned["customers"])
    translation = dims.get("dim_translation")
    translation = translation if translation is not None else translation_dim(cleaned["category_translation"])
    items = aggs["agg_order_items"]
    cat = aggs["agg_order_dominant_category"]
    seller = aggs["agg_order_dominant_seller"]
    pay = aggs["agg_order_payments"]
    rev = aggs["agg_order_reviews"]
    if threshold is None:
        threshold = high_value_threshold(pay)
    p75 = threshold.first()
    p75 = p75[0] if p75 is not None else None

    j = (
        with_customers(cleaned["orders"], customers)
        .join(items.withColumn("_items", F.lit(1)).alias("ia"), "order_id", "left")
        .join(cat.alias("dc"), "order_id", "left")
        .join(seller.alias("ds"), "order_id", "left")
        .join(pay.withColumn("_pay", F.lit(1)).alias("pa"), "order_id", "left")
        .join(rev.withColumn("_rev", F.lit(1)).alias("ra"), "order_id", "left")
        .join(translation.alias("tr"),
              F.col("dc.dominant_category") == F.col("tr.product_category_name"), "left")
    )
    delay = F.when(
        F.col("order_delivered_customer_date").isNotNull() & F.col("order_estimated_delivery_date").isNotNull(),
        days_between("order_estimated_delivery_date", "order_delivered_customer_date"),
    )
    processing = F.when(
        F.col("order_approved_at").isNotNull() & F.col("order_purchase_timestamp").isNotNull(),
        days_between("order_purchase_timestamp", "order_approved_at"),
    )
    paid = F.coalesce(F.col("total_payment_value"), dec("0.00"))
    high_value = flag(paid > F.lit(p75).cast(MONEY)) if p75 is not None else F.lit(0)
    out = j.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "customer_city",
        "customer_state",
        F.coalesce(F.col("total_item_value"), dec("0.00")).cast(MONEY).alias("total_order_value"),
        F.coalesce(F.col("total_freight_value"), dec("0.00")).cast(MONEY).alias("total_freight_value"),
        paid.cast(MONEY).alias("total_payment_value"),
        F.coalesce(F.col("avg_payment_installments"), dec("1.00")).cast("decimal(18,2)").alias("avg_payment_installments"),
        F.coalesce(F.col("total_items"), F.lit(0)).cast("bigint").alias("total_items"),
        F.coalesce(F.col("unique_products"), F.lit(0)).cast("bigint").alias("unique_products"),
        "dominant_category",
        F.col("product_category_name_english").alias("category_english"),
        F.coalesce(F.col("unique_sellers"), F.lit(0)).cast("bigint").alias("unique_sellers"),
        "dominant_seller_state",
        "avg_review_score",
        F.coalesce(F.col("review_count"), F.lit(0)).cast("bigint").alias("review_count"),
        F.month("order_purchase_timestamp").alias("order_month"),
        F.year("order_purchase_timestamp").alias("order_year"),
        weekday_name("order_purchase_timestamp").alias("order_day_of_week"),
        delay.alias("delivery_delay_days"),
        processing.alias("processing_time_days"),
        flag(delay > 0).alias("is_delayed_delivery"),
        high_value.alias("is_high_value_order"),
        flag((F.coalesce(F.col("payment_row_count"), F.lit(0)) > 1)
             | (F.coalesce(F.col("distinct_payment_types"), F.lit(0)) > 1)).alias("is_multi_payment"),
        flag(F.coalesce(F.col("total_items"), F.lit(0)) > 1).alias("is_multi_item_order"),
        "timestamp_sequence_flag",
        flag(F.col("_cust").isNull()).alias("ri_missing_customer"),
        flag(F.col("_items").isNull()).alias("ri_missing_items"),
        flag(F.col("_pay").isNull()).alias("ri_missing_payment"),
        flag(F.col("_rev").isNull()).alias("ri_missing_review"),
    )
    return out


# ---- RI audit -------------------------------------------------------------------

def ri_checks(cleaned: dict[str, DataFrame]) -> DataFrame:
    c = cleaned
    checks = [
        ri_check("orders -> customers", c["orders"], "customer_id", c["customers"], "customer_id"),
        ri_check("order_items -> orders", c["order_items"], "order_id", c["orders"], "order_id"),
        ri_check("payments -> orders", c["payments"], "order_id", c["orders"], "order_id"),
        ri_check("reviews -> orders", c["reviews"], "order_id", c["orders"], "order_id"),
        ri_check("order_items -> products", c["order_items"], "product_id", c["products"], "product_id"),
        ri_check("order_items -> sellers", c["order_items"], "seller_id", c["sellers"], "seller_id"),
    ]
    out = checks[0]
    for x in checks[1:]:
        out = out.unionByName(x)
    return out
