"""The profiling pass over the nine raw inputs (one operator call per table)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import counts as C
from ..operators import profile as P
from .cleaning import LAT_MAX, LAT_MIN, LNG_MAX, LNG_MIN

# ---- fixed values (must equal the reference's literals) ----------------------
ZIP_MIN, ZIP_MAX = 1000, 99999
SCORE_MIN, SCORE_MAX = 1, 5
# -----------------------------------------------------------------------------

DISTINCT_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "orders": ["order_id", "customer_id", "order_status"],
    "order_items": ["order_id", "product_id", "seller_id"],
    "payments": ["order_id", "payment_type"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "reviews": ["review_id", "order_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}
DUPLICATE_KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "reviews": ["review_id"],
    "category_translation": ["product_category_name"],
}
UNLIMITED_DUPLICATE_LIST = {"category_translation"}
DISTRIBUTIONS = [("customers", "customer_state"), ("orders", "order_status"), ("payments", "payment_type"),
                 ("sellers", "seller_state"), ("reviews", "review_score"), ("geolocation", "geolocation_state")]
RANGES = [("customers", "customer_zip_code_prefix", ZIP_MIN, ZIP_MAX),
          ("sellers", "seller_zip_code_prefix", ZIP_MIN, ZIP_MAX),
          ("geolocation", "geolocation_zip_code_prefix", ZIP_MIN, ZIP_MAX),
          ("geolocation", "geolocation_lat", float(LAT_MIN), float(LAT_MAX)),
          ("geolocation", "geolocation_lng", float(LNG_MIN), float(LNG_MAX))]
NUMERIC = [("order_items", "price", 2), ("order_items", "freight_value", 2),
           ("payments", "payment_value", 2), ("payments", "payment_installments", 0)]
DIMENSIONS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
              "product_name_length", "product_description_length", "product_photos_qty"]
TIMESTAMPS = {"orders": ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                         "order_delivered_customer_date", "order_estimated_delivery_date"],
              "reviews": ["review_creation_date", "review_answer_timestamp"]}
ORDER_STEPS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date"]
KEY_OVERLAP = {
    "customer_id": [("customers", "customer_id"), ("orders", "customer_id")],
    "order_id": [("orders", "order_id"), ("order_items", "order_id"), ("payments", "order_id"), ("reviews", "order_id")],
    "product_id": [("products", "product_id"), ("order_items", "product_id")],
    "seller_id": [("sellers", "seller_id"), ("order_items", "seller_id")],
}
OVERLAP_TABLES = list(dict.fromkeys(t for pairs in KEY_OVERLAP.values() for t, _ in pairs))


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(raw: dict[str, DataFrame]) -> DataFrame:
    return _union(P.row_count(df, t) for t, df in raw.items())


def null_counts(raw):
    return _union(P.null_counts(df, t) for t, df in raw.items())


def raw_keys(table: str) -> list[list[str]]:
    """Every key of a raw table that some profile counts."""
    keys = [[c] for c in DISTINCT_COLUMNS[table]] + [k for t, k in DUPLICATE_KEYS.items() if t == table]
    keys += [[c] for pairs in KEY_OVERLAP.values() for t, c in pairs if t == table]
    return [list(k) for k in dict.fromkeys(map(tuple, keys))]


def distinct_counts(counts: dict[str, DataFrame]) -> DataFrame:
    return _union(C.distinct_counts(counts[t], [[c] for c in cols]).select(
        F.lit(t).alias("table_name"), F.col("key_columns").alias("column_name"), "distinct_count") for t, cols in DISTINCT_COLUMNS.items())


def duplicate_keys(counts: dict[str, DataFrame]) -> DataFrame:
    return _union(C.duplicate_keys(counts[t], keys, None if t in UNLIMITED_DUPLICATE_LIST else 20).select(F.lit(t).alias("table_name"), "*")
                  for t, keys in DUPLICATE_KEYS.items())


def exact_duplicates(raw):
    return _union(P.exact_duplicate_groups(df, t) for t, df in raw.items())


def exact_duplicates_from_groups(groups):
    """Same answer from the written identical-row groups (column ``_n``)."""
    return _union(g.filter(F.col("_n") > 1).agg(F.count(F.lit(1)).alias("exact_duplicate_groups"))
                  .select(F.lit(t).alias("table_name"), "exact_duplicate_groups") for t, g in groups.items())


def value_distributions(raw):
    return _union(P.value_distribution(raw[t], t, c) for t, c in DISTRIBUTIONS)


def top_categories(raw):
    return P.top_values(raw["products"], "product_category_name", 20)


def range_checks(raw):
    return _union(P.range_check(raw[t], t, c, lo, hi) for t, c, lo, hi in RANGES)


def numeric_summaries(raw):
    return _union(P.numeric_summary(raw[t], t, c, s) for t, c, s in NUMERIC)


def dimension_ranges(raw):
    return P.dimension_ranges(raw["products"], DIMENSIONS)


def timestamp_ranges(raw):
    return _union(P.timestamp_range(raw[t], t, cols) for t, cols in TIMESTAMPS.items())


def sequence_violations(raw):
    return P.sequence_violations(raw["orders"], ORDER_STEPS)


def invalid_scores(raw):
    return P.invalid_domain(raw["reviews"], "reviews", "review_score", SCORE_MIN, SCORE_MAX)


def multi_payment_orders(counts: dict[str, DataFrame]) -> DataFrame:
    entities = C.repeated_keys(counts["payments"], [["order_id"]], with_null=False)
    return entities.agg(F.coalesce(F.sum("keys_with_multiple_rows"), F.lit(0)).alias("entities_with_multiple_rows"))


def line_number_stats(raw):
    return P.line_number_stats(raw["order_items"], "order_item_id")


def key_overlap(counts: dict[str, DataFrame]) -> DataFrame:
    return _union(C.distinct_counts(counts[t], [[c]]).select(F.lit(key).alias("key_name"), F.lit(t).alias("table_name"), F.col("distinct_count").alias("distinct_keys"))
                  for key, pairs in KEY_OVERLAP.items() for t, c in pairs)


def translation_listing(raw):
    return raw["category_translation"].orderBy("product_category_name")
