"""Validation checks of the cleaned tables (both generations) and of the order fact.

Every check is an aggregation whose result has a handful of rows; checks
over several tables tag each table's rows and aggregate ONE union instead of
scanning per check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bucketize, count_if
from ..operators import profile as P
from .cleaning import LAT_MAX, LAT_MIN, LNG_MAX, LNG_MIN, PAYMENT_TYPES, gen1_specs, gen2_specs, row_key, tagged
from .warehouse import GENERATIONS, Warehouse

TABLES = ["customers", "orders", "order_items", "payments", "products", "sellers", "reviews", "geolocation",
          "category_translation"]
UNIQUE_KEYS = {
    "customers": ["customer_id"], "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"], "products": ["product_id"], "sellers": ["seller_id"],
    "category_translation": ["product_category_name"],
}

# ---- fixed values (must equal the reference's literals) ----------------------
NULL_SUMMARY = {
    "customers": [("null_customer_id", "customer_id"), ("null_unique_id", "customer_unique_id"),
                  ("null_state", "customer_state")],
    "orders": [("null_order_id", "order_id"), ("null_customer_id", "customer_id"), ("null_status", "order_status"),
               ("null_purchase_ts", "order_purchase_timestamp"), ("flagged_ts_violations", "+timestamp_sequence_flag")],
    "order_items": [("null_order_id", "order_id"), ("null_product_id", "product_id"), ("null_seller_id", "seller_id"),
                    ("null_price", "price"), ("null_freight", "freight_value")],
    "payments": [("null_order_id", "order_id"), ("null_payment_type", "payment_type"),
                 ("null_payment_value", "payment_value")],
    "products": [("null_product_id", "product_id"), ("missing_category_flagged", "+category_missing_flag"),
                 ("missing_dimensions_flagged", "+dimensions_missing_flag")],
    "sellers": [("null_seller_id", "seller_id"), ("null_state", "seller_state")],
    "reviews": [("null_review_id", "review_id"), ("null_review_score", "review_score"),
                ("null_comment_title", "review_comment_title")],
    "geolocation": [("null_lat", "geolocation_lat"), ("null_lng", "geolocation_lng"),
                    ("null_state", "geolocation_state")],
}
_TYPES = ", ".join(f"'{t}'" for t in PAYMENT_TYPES)
BUSINESS_RULES = [
    ("orders_with_ts_violation", "orders", "timestamp_sequence_flag = 1"),
    ("invalid_price_in_cleaned", "order_items", "price IS NULL OR price <= 0"),
    ("invalid_freight_in_cleaned", "order_items", "freight_value < 0"),
    ("invalid_payment_in_cleaned", "payments",
     f"payment_value <= 0 OR payment_type NOT IN ({_TYPES}) OR payment_installments < 1"),
    ("invalid_score_in_cleaned", "reviews", "review_score NOT BETWEEN 1 AND 5"),
    ("coords_outside_brazil_in_cleaned", "geolocation",
     f"geolocation_lat NOT BETWEEN {LAT_MIN} AND {LAT_MAX} OR geolocation_lng NOT BETWEEN {LNG_MIN} AND {LNG_MAX}"),
]
DELIVERY_BUCKETS = [
    ("Not Delivered / No Estimate", "delivery_delay_days IS NULL"),
    ("Early (< 0 days)", "delivery_delay_days < 0"),
    ("On Time (0 days)", "delivery_delay_days = 0"),
    ("Late 1–7 days", "delivery_delay_days BETWEEN 1 AND 7"),
    ("Late 8–30 days", "delivery_delay_days BETWEEN 8 AND 30"),
]
DELIVERY_DEFAULT = "Very Late (> 30 days)"
PROCESSING_BUCKETS = [
    ("No Approval Timestamp", "processing_time_days IS NULL"),
    ("Anomaly (negative)", "processing_time_days < 0"),
    ("Same Day Approval", "processing_time_days = 0"),
    ("1 Day", "processing_time_days = 1"),
    ("2–7 Days", "processing_time_days BETWEEN 2 AND 7"),
]
PROCESSING_DEFAULT = "Over 7 Days"
ITEMS_BUCKETS = [
    ("0 (no items linked)", "total_items = 0"),
    ("1 item", "total_items = 1"),
    ("2–5 items", "total_items BETWEEN 2 AND 5"),
    ("6–10 items", "total_items BETWEEN 6 AND 10"),
]
ITEMS_DEFAULT = "Over 10 items"
FACT_NULL_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "customer_unique_id",
                     "customer_state", "order_month", "order_year", "order_day_of_week", "total_order_value",
                     "total_payment_value"]
REVENUE_TOLERANCE = "1.00"
# -----------------------------------------------------------------------------


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _rules(rules, default) -> Column:
    return bucketize(None, [(F.expr(c), label) for label, c in rules], default)


# ---- 2.3 cleaning operators as queries -----------------------------------------------------

def _specs(gen: int):
    return gen1_specs() if gen == 1 else gen2_specs()


def rejects_with_reason(w: Warehouse, gen: int, table: str, like: str) -> DataFrame:
    return w.rejects(table, GENERATIONS[gen]).filter(F.col("reject_reason").like(like))


def _tagged_rejects(w: Warehouse, chosen) -> DataFrame:
    """Rejects of (generation, table, condition) in the one format of all tables."""
    return _union(tagged(w.rejects(t, GENERATIONS[gen]).filter(cond), gen, t, ("reject_reason", "rejected_row_count"))
                  for gen, t, cond in chosen)


def rule_rejects(w: Warehouse) -> DataFrame:
    """Rows that broke a business rule, with the first rule's reason, of every table that has rules."""
    return _tagged_rejects(w, [(gen, t, F.col("reject_reason").isin([r for r, _ in spec.rules]))
                               for gen in GENERATIONS for t, spec in _specs(gen).items() if spec.rules])


def exact_duplicate_rejects(w: Warehouse, gen: int) -> DataFrame:
    """Surplus copies of all tables: one row per copy (generation 1) or per group (generation 2)."""
    return _tagged_rejects(w, [(gen, t, F.col("reject_reason").startswith("EXACT_DUPLICATE_ROW")) for t in TABLES])


def duplicate_flags(w: Warehouse) -> DataFrame:
    """Every cleaned row of the tables with a duplicate flag (generation 2): its key and the flag."""
    return _union(w.cleaned(t).select(F.lit(t).alias("table_name"), P.key_string(row_key(t)).alias("key_value"), "duplicate_flag")
                  for t, spec in gen2_specs().items() if spec.duplicate_flag)


def kept_rows(w: Warehouse) -> DataFrame:
    """The row that generation 1 keeps of each key, of all tables with a keep-first rule."""
    return _union(tagged(w.cleaned(t, GENERATIONS[1]), 1, t) for t, spec in gen1_specs().items() if spec.dup_reason)


def distinct_rows(w: Warehouse) -> DataFrame:
    """Distinct geolocation rows of both generations: after normalising and the bounds (1), before both (2)."""
    return _union(tagged(w.cleaned("geolocation", mode), gen, "geolocation") for gen, mode in GENERATIONS.items())


def standardized_texts(w: Warehouse) -> DataFrame:
    """Normalised text columns of the cleaned rows of all tables that have some, both generations."""
    return _union(tagged(w.cleaned(t, mode), gen, t, values=list(_specs(gen)[t].normalise))
                  for gen, mode in GENERATIONS.items() for t in TABLES if _specs(gen)[t].normalise)


def null_key_rejects(w: Warehouse) -> DataFrame:
    r = w.reject_reasons().filter(F.col("reject_reason").startswith("NULL_"))
    return r.select("generation", "dataset", "reject_reason", F.col("cnt").alias("rejected_rows"))


def dup_key_rejects(w: Warehouse) -> DataFrame:
    out = []
    for t, keys in UNIQUE_KEYS.items():
        if t in ("order_items", "payments"):
            continue
        r = rejects_with_reason(w, 1, t, "DUPLICATE_%")
        out.append(r.select(F.lit(t).alias("dataset"), P.key_string(keys).alias("key_value"), "reject_reason"))
    return _union(out)


def _entry(layer: str, measure: str = "rows") -> Column:
    """Value of one measure of the ledger, where rows of one dataset are grouped."""
    return F.max(F.when((F.col("layer") == layer) & (F.col("measure") == measure), F.col("value")))


def clean_summary(w: Warehouse) -> DataFrame:
    g = w.cleaning_ledger().filter("generation = 2").groupBy(F.col("dataset").alias("table_name"))
    return g.agg(_entry("cleaned").alias("cleaned_rows"), _entry("cleaned", "flagged").alias("flagged_rows"),
                 _entry("rejects").alias("rejected_rows"))


# ---- 2.4 cleaning validation --------------------------------------------------------------------

def row_accounting(w: Warehouse) -> DataFrame:
    """raw = cleaned + represented by rejects, for both generations, from the ledger alone."""
    both = F.explode(F.when(F.col("generation").isNull(), F.array(*[F.lit(g).cast("bigint") for g in GENERATIONS])).otherwise(F.array("generation")))
    entries = w.cleaning_ledger().filter(F.col("layer").isin("raw", "cleaned", "rejects")).withColumn("generation", both)
    g = entries.groupBy("generation", "dataset").agg(
        _entry("raw").alias("raw_rows"), _entry("cleaned").alias("cleaned_rows"), _entry("rejects").alias("rejected_rows"),
        _entry("rejects", "represented").alias("represented_rows"))
    return g.withColumn("unaccounted_rows", F.col("raw_rows") - F.col("cleaned_rows") - F.col("represented_rows"))


def unique_keys(w: Warehouse) -> DataFrame:
    """Keys that stand on several rows of a cleaned table, from its stored counts per key."""
    todo = [(gen, mode, t, keys) for gen, mode in GENERATIONS.items() for t, keys in UNIQUE_KEYS.items()]
    counts = w._parallel([(t, mode, tuple(keys)) for _, mode, t, keys in todo], lambda x: w.unique_key_counts(x[0], x[1], list(x[2])))
    return _union(counts[t, mode, tuple(keys)].agg(F.count(F.when(F.col("occurrences") > 1, 1)).alias("duplicate_count")).select(
        F.lit(gen).cast("bigint").alias("generation"), F.lit(t).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"), "duplicate_count")
        for gen, mode, t, keys in todo)


def null_summary(w: Warehouse) -> DataFrame:
    out = []
    for gen, mode in GENERATIONS.items():
        for t, measures in NULL_SUMMARY.items():
            aggs = [(F.sum(F.col(c[1:])).cast("bigint") if c.startswith("+") else count_if(F.col(c).isNull()))
                    .alias(f"m{i}") for i, (_, c) in enumerate(measures)]
            wide = w.cleaned(t, mode).agg(*aggs).withColumn("generation", F.lit(gen).cast("bigint")) \
                .withColumn("table_name", F.lit(t))
            out.append(P._stack(wide, ["generation", "table_name"], [(m, f"m{i}") for i, (m, _) in enumerate(measures)],
                                "measure", "value"))
    return _union(out)


def reject_breakdown(w: Warehouse) -> DataFrame:
    return w.reject_reasons()


def business_rules(w: Warehouse) -> DataFrame:
    out = []
    for gen, mode in GENERATIONS.items():
        for name, t, cond in BUSINESS_RULES:
            out.append(w.cleaned(t, mode).agg(count_if(F.expr(cond)).alias("violations")).select(
                F.lit(gen).cast("bigint").alias("generation"), F.lit(name).alias("check_name"), "violations"))
    return _union(out)


# ---- 2.6 fact validation ------------------------------------------------------------------------

def fact_grain(w: Warehouse) -> DataFrame:
    f = w.fact()
    dup = f.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    stats = f.agg(F.count(F.lit(1)).alias("total"), F.countDistinct("order_id").alias("distinct_ids")) \
        .crossJoin(dup.agg(F.count(F.lit(1)).alias("dups"))) \
        .crossJoin(w.cleaned("orders").agg(F.countDistinct("order_id").alias("source")))
    rows = [("Total rows in fact_order_master", "total"), ("Distinct order_ids in fact_order_master", "distinct_ids"),
            ("DUPLICATE ORDER_IDs (must be 0)", "dups"), ("Source orders (cleaned_orders, non-dup preferred)", "source"),
            ("Rows in fact vs source (diff must be 0)", "diff")]
    stats = stats.withColumn("diff", F.col("distinct_ids") - F.col("source"))
    return P._stack(stats, [], rows, "check_name", "value")


def revenue_consistency(w: Warehouse) -> DataFrame:
    f = w.fact().filter((F.col("ri_missing_items") == 0) & (F.col("ri_missing_payment") == 0))
    gap = F.abs(F.col("total_order_value") + F.col("total_freight_value") - F.col("total_payment_value"))
    tol = F.lit(REVENUE_TOLERANCE).cast("decimal(3,2)")
    return f.agg(
        F.count(F.lit(1)).alias("total_orders_with_both"),
        count_if(gap < tol).alias("revenue_consistent_within_1_brl"),
        count_if(gap >= tol).alias("revenue_discrepancy_over_1_brl"),
        F.round(F.avg(gap), 2).alias("avg_abs_discrepancy_brl"),
        F.round(F.max(gap), 2).alias("max_abs_discrepancy_brl"),
    )


def fact_nulls(w: Warehouse) -> DataFrame:
    return P.null_counts(w.fact(), "fact_order_master", FACT_NULL_COLUMNS).drop("table_name")


def fact_ri_summary(w: Warehouse) -> DataFrame:
    return w.fact().agg(
        F.count(F.lit(1)).alias("total_orders_in_fact"),
        F.sum("ri_missing_customer").cast("bigint").alias("orders_with_no_customer_match"),
        F.sum("ri_missing_items").cast("bigint").alias("orders_with_no_items"),
        F.sum("ri_missing_payment").cast("bigint").alias("orders_with_no_payment"),
        F.sum("ri_missing_review").cast("bigint").alias("orders_with_no_review"),
        F.sum("timestamp_sequence_flag").cast("bigint").alias("orders_with_ts_violation"),
    )


def _bucket_counts(df: DataFrame, name: str, rules, default) -> DataFrame:
    return df.withColumn(name, _rules(rules, default)).groupBy(name).agg(F.count(F.lit(1)).alias("order_count"))


def delivery_buckets(w):
    return _bucket_counts(w.fact(), "delivery_bucket", DELIVERY_BUCKETS, DELIVERY_DEFAULT)


def processing_buckets(w):
    return _bucket_counts(w.fact(), "processing_bucket", PROCESSING_BUCKETS, PROCESSING_DEFAULT)


def items_buckets(w):
    return _bucket_counts(w.fact(), "items_bucket", ITEMS_BUCKETS, ITEMS_DEFAULT)


def flag_totals(w: Warehouse) -> DataFrame:
    return w.fact().agg(*[F.sum(c).cast("bigint").alias(a) for c, a in (
        ("is_delayed_delivery", "delayed_orders"), ("is_high_value_order", "high_value_orders"),
        ("is_multi_payment", "multi_payment_orders"), ("is_multi_item_order", "multi_item_orders"))],
        F.count(F.lit(1)).alias("total_orders"))


def status_distribution(w: Warehouse) -> DataFrame:
    return w.fact().groupBy("order_status").agg(F.count(F.lit(1)).alias("cnt"))


def payment_stats(w: Warehouse) -> DataFrame:
    s = w.fact().filter(F.col("total_payment_value") > 0).agg(
        F.min("total_payment_value").alias("min_payment"), F.max("total_payment_value").alias("max_payment"),
        F.round(F.avg("total_payment_value"), 2).alias("avg_payment"))
    return s.crossJoin(F.broadcast(w.threshold().select(F.col("p75_threshold").alias("p75_threshold_used"))))


def date_coverage(w: Warehouse) -> DataFrame:
    return w.fact().agg(
        F.min("order_purchase_timestamp").alias("earliest_order"),
        F.max("order_purchase_timestamp").alias("latest_order"),
        F.countDistinct("order_year").alias("years_covered"),
        F.countDistinct("order_month").alias("months_with_orders"))


def top_states(w: Warehouse, n: int = 10) -> DataFrame:
    g = w.fact().groupBy("customer_state").agg(F.count(F.lit(1)).alias("order_count"))
    return g.orderBy(F.col("order_count").desc(), F.col("customer_state").asc_nulls_first()).limit(n)


def top_categories(w: Warehouse, n: int = 10) -> DataFrame:
    g = w.fact().filter(F.col("dominant_category").isNotNull()).groupBy("dominant_category") \
        .agg(F.count(F.lit(1)).alias("order_count"))
    return g.orderBy(F.col("order_count").desc(), F.col("dominant_category")).limit(n)


def review_score_distribution(w: Warehouse) -> DataFrame:
    f = w.fact().filter(F.col("avg_review_score").isNotNull())
    return f.groupBy(F.round("avg_review_score", 0).alias("score_bucket")).agg(F.count(F.lit(1)).alias("order_count"))
