"""All oracle SQL strings, keyed like ``souk.plans.catalog.QUERIES``."""

from __future__ import annotations

from . import analytics_sql, fact_sql  # noqa: F401  (register CTEs)
from .analytics_sql import QUERIES as _ANALYTICS, out
from .ctes import assemble

ORACLE: dict[str, str] = {}
ORACLE.update(_ANALYTICS)

FACT_DOUBLES = ["total_order_value", "total_freight_value", "total_payment_value", "avg_payment_installments",
                "avg_review_score"]
FACT_BIGINTS = ["order_month", "order_year", "delivery_delay_days", "processing_time_days", "is_delayed_delivery",
                "is_high_value_order", "is_multi_payment", "is_multi_item_order", "timestamp_sequence_flag",
                "ri_missing_customer", "ri_missing_items", "ri_missing_payment", "ri_missing_review"]
MART_DOUBLES = ["total_spend", "avg_order_value", "min_order_value", "max_order_value", "monetary",
                "avg_days_between_orders", "avg_delivery_delay", "delayed_order_ratio", "multi_item_ratio",
                "multi_payment_ratio", "avg_customer_review_score", "avg_items_per_order", "avg_freight_per_order",
                "avg_sellers_per_order", "avg_products_per_order", "high_value_order_ratio"]
MART_BIGINTS = ["customer_lifetime_days", "recency_days", "r_score", "f_score", "m_score", "rfm_score",
                "cohort_year", "repeat_purchase_flag", "is_one_time_buyer", "days_since_first_order"]


def _pick(cols, doubles, bigints):
    return [c for c in doubles if c in cols], [c for c in bigints if c in cols]


def fact_cols(*cols) -> str:
    d, b = _pick(cols, FACT_DOUBLES, FACT_BIGINTS)
    return out(f"SELECT {', '.join(cols)} FROM fact", d, b)


def mart_cols(*cols) -> str:
    d, b = _pick(cols, MART_DOUBLES, MART_BIGINTS)
    return out(f"SELECT {', '.join(cols)} FROM mart", d, b)


ORACLE["fact_order_master"] = out("SELECT * FROM fact", FACT_DOUBLES, FACT_BIGINTS)
ORACLE["mart_customer_features"] = out("SELECT * FROM mart", MART_DOUBLES, MART_BIGINTS)

ORACLE["agg_order_items"] = out("SELECT * FROM agg_items", ["total_item_value", "total_freight_value"],
                                ["total_items", "unique_products", "unique_sellers"])
ORACLE["agg_dominant_category"] = "SELECT * FROM dom_category"
ORACLE["agg_dominant_seller_state"] = "SELECT * FROM dom_seller"
ORACLE["agg_order_payments"] = out("SELECT * FROM agg_payments", ["total_payment_value", "avg_payment_installments"],
                                   ["payment_row_count", "distinct_payment_types"])
ORACLE["agg_order_reviews"] = out("SELECT * FROM agg_reviews", ["avg_review_score"], ["review_count"])
ORACLE["p75_threshold"] = out("SELECT * FROM hv_threshold", ["p75_threshold"])

_RI = [("orders -> customers", "cleaned_orders", "customer_id", "cleaned_customers", "customer_id"),
       ("order_items -> orders", "cleaned_order_items", "order_id", "cleaned_orders", "order_id"),
       ("payments -> orders", "cleaned_payments", "order_id", "cleaned_orders", "order_id"),
       ("reviews -> orders", "cleaned_reviews", "order_id", "cleaned_orders", "order_id"),
       ("order_items -> products", "cleaned_order_items", "product_id", "cleaned_products", "product_id"),
       ("order_items -> sellers", "cleaned_order_items", "seller_id", "cleaned_sellers", "seller_id")]
ORACLE["ri_check"] = out("\nUNION ALL\n".join(
    f"SELECT '{name}' AS ri_check, count(*) AS total_rows,"
    f" SUM(CASE WHEN p.k IS NULL THEN 1 ELSE 0 END) AS orphan_rows,"
    f" ROUND(CAST(SUM(CASE WHEN p.k IS NULL THEN 1 ELSE 0 END) * 100.0 / NULLIF(count(*), 0) AS DECIMAL(38,9)), 2)"
    f" AS orphan_pct"
    f" FROM {child} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {parent}) p ON c.{ck} = p.k"
    for name, child, ck, parent, pk in _RI), ["orphan_pct"], ["total_rows", "orphan_rows"])

ORACLE["dim_dedupe"] = """
SELECT 'customers' AS dim, customer_id AS key, concat_ws('|', customer_unique_id, customer_city, customer_state) AS attributes
FROM dim_customers
UNION ALL SELECT 'sellers', seller_id, concat_ws('|', seller_state, seller_city) FROM dim_sellers
UNION ALL SELECT 'products', product_id, COALESCE(product_category_name, '') FROM dim_products
UNION ALL SELECT 'category_translation', product_category_name, COALESCE(product_category_name_english, '')
FROM dim_translation
"""

ORACLE["fact_temporal_features"] = fact_cols("order_id", "order_month", "order_year", "order_day_of_week")
ORACLE["fact_delivery_delay"] = fact_cols("order_id", "delivery_delay_days")
ORACLE["fact_processing_time"] = fact_cols("order_id", "processing_time_days")
ORACLE["fact_order_flags"] = fact_cols("order_id", "is_delayed_delivery", "is_high_value_order", "is_multi_payment",
                                       "is_multi_item_order")
ORACLE["fact_ri_flags"] = fact_cols("order_id", "ri_missing_customer", "ri_missing_items", "ri_missing_payment",
                                    "ri_missing_review")

ORACLE["reference_date"] = "SELECT ref_date FROM ref_date"
_AGG_COLS = ["customer_unique_id", "total_orders", "total_spend", "avg_order_value", "min_order_value",
             "max_order_value", "recency_days", "first_order_date", "last_order_date", "customer_lifetime_days",
             "avg_delivery_delay", "delayed_order_ratio", "multi_item_ratio", "multi_payment_ratio",
             "avg_customer_review_score", "avg_items_per_order", "avg_freight_per_order", "avg_sellers_per_order",
             "avg_products_per_order", "total_categories_purchased", "delivered_orders", "cancelled_orders",
             "shipped_orders", "high_value_order_ratio", "total_reviews_given", "frequency", "monetary"]
ORACLE["customer_agg"] = out(
    "SELECT *, total_orders AS frequency, total_spend AS monetary FROM cust_agg",
    *_pick(_AGG_COLS, MART_DOUBLES, MART_BIGINTS))
ORACLE["customer_last_location"] = "SELECT * FROM cust_location"
ORACLE["customer_preferred_category"] = "SELECT * FROM cust_pref_cat"
ORACLE["customer_preferred_day"] = "SELECT * FROM cust_pref_day"
ORACLE["customer_recency_windows"] = mart_cols("customer_unique_id", "orders_last_30d", "orders_last_60d",
                                               "orders_last_90d", "orders_last_180d")
ORACLE["rfm_scores"] = mart_cols("customer_unique_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_label")
ORACLE["lifecycle_stage"] = mart_cols("customer_unique_id", "recency_days", "lifecycle_stage")
ORACLE["segment_label"] = mart_cols("customer_unique_id", "r_score", "f_score", "m_score", "total_orders",
                                    "segment_label")
ORACLE["retention_features"] = mart_cols("customer_unique_id", "cohort_month", "cohort_year", "repeat_purchase_flag",
                                         "is_one_time_buyer", "avg_days_between_orders", "days_since_first_order")


from .profile_sql import Q as _PROFILE  # noqa: E402

ORACLE.update(_PROFILE)

from .checks_sql import Q as _CHECKS  # noqa: E402

ORACLE.update(_CHECKS)

from .mart_checks_sql import Q as _MART_CHECKS  # noqa: E402

ORACLE.update(_MART_CHECKS)

from .sources_sql import Q as _SOURCES  # noqa: E402

ORACLE.update(_SOURCES)


def oracle_sql() -> dict[str, str]:
    return {k: assemble(v) for k, v in ORACLE.items()}
