"""Named queries: inventory key -> DataFrame builder over a Warehouse.

Every builder reads the warehouse's layers, which derive from the given
input tables, so the work of every query grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import analytics as A
from . import fact as FP
from . import mart as MP
from . import views as V
from .warehouse import Warehouse

Builder = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Builder] = {}


def query(key: str):
    def deco(fn: Builder) -> Builder:
        QUERIES[key] = fn
        return fn

    return deco


def finalize(df: DataFrame) -> DataFrame:
    """Output convention: DECIMAL -> DOUBLE (exact values, rounded in DECIMAL first),
    integral types -> BIGINT, booleans kept."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(cols)


# ---- 2.5 fact and its parts -----------------------------------------------------------
query("fact_order_master")(lambda w: w.fact())
query("agg_order_items")(lambda w: w.order_agg("agg_order_items"))
query("agg_dominant_category")(lambda w: w.order_agg("agg_order_dominant_category"))
query("agg_dominant_seller_state")(lambda w: w.order_agg("agg_order_dominant_seller"))
query("agg_order_payments")(lambda w: w.payment_agg())
query("agg_order_reviews")(lambda w: w.order_agg("agg_order_reviews"))
query("p75_threshold")(lambda w: w.threshold())
query("ri_check")(lambda w: FP.ri_checks(w.cleaned_all()))


@query("dim_dedupe")
def _dim_dedupe(w: Warehouse) -> DataFrame:
    c = w.dim("dim_customers").select(
        F.lit("customers").alias("dim"), F.col("customer_id").alias("key"),
        F.concat_ws("|", "customer_unique_id", "customer_city", "customer_state").alias("attributes"))
    s = w.dim("dim_sellers").select(
        F.lit("sellers").alias("dim"), F.col("seller_id").alias("key"),
        F.concat_ws("|", "seller_state", "seller_city").alias("attributes"))
    p = w.dim("dim_products").select(
        F.lit("products").alias("dim"), F.col("product_id").alias("key"),
        F.coalesce(F.col("product_category_name"), F.lit("")).alias("attributes"))
    t = w.dim("dim_translation").select(
        F.lit("category_translation").alias("dim"), F.col("product_category_name").alias("key"),
        F.coalesce(F.col("product_category_name_english"), F.lit("")).alias("attributes"))
    return c.unionByName(s).unionByName(p).unionByName(t)


query("fact_temporal_features")(lambda w: w.fact().select("order_id", "order_month", "order_year", "order_day_of_week"))
query("fact_delivery_delay")(lambda w: w.fact().select("order_id", "delivery_delay_days"))
query("fact_processing_time")(lambda w: w.fact().select("order_id", "processing_time_days"))
query("fact_order_flags")(lambda w: w.fact().select(
    "order_id", "is_delayed_delivery", "is_high_value_order", "is_multi_payment", "is_multi_item_order"))
query("fact_ri_flags")(lambda w: w.fact().select(
    "order_id", "ri_missing_customer", "ri_missing_items", "ri_missing_payment", "ri_missing_review"))

# ---- 2.7 mart and its parts --------------------------------------------------------------
query("mart_customer_features")(lambda w: w.mart())
query("reference_date")(lambda w: w.ref_date())


@query("customer_agg")
def _customer_agg(w: Warehouse) -> DataFrame:
    return w.customer_agg().drop(*[f"orders_last_{d}d" for d in MP.RECENCY_WINDOWS])


query("customer_last_location")(lambda w: w.mart().select("customer_unique_id", "customer_city", "customer_state"))
query("customer_preferred_category")(lambda w: w.preferred("category"))
query("customer_preferred_day")(lambda w: w.preferred("day"))
query("customer_recency_windows")(lambda w: w.mart().select(
    "customer_unique_id", *[f"orders_last_{d}d" for d in MP.RECENCY_WINDOWS]))
query("rfm_scores")(lambda w: w.mart().select(
    "customer_unique_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_label"))
query("lifecycle_stage")(lambda w: w.mart().select("customer_unique_id", "recency_days", "lifecycle_stage"))
query("segment_label")(lambda w: w.mart().select(
    "customer_unique_id", "r_score", "f_score", "m_score", "total_orders", "segment_label"))
query("retention_features")(lambda w: w.mart().select(
    "customer_unique_id", "cohort_month", "cohort_year", "repeat_purchase_flag", "is_one_time_buyer",
    "avg_days_between_orders", "days_since_first_order"))
query("mart_distributions")(lambda w: A.mart_distributions(w.mart()))

# ---- 2.9 analytics -------------------------------------------------------------------------
for _key in ("kpi_summary", "revenue_deciles", "segment_metrics",
             "segment_ranking", "segment_top_customers", "lifecycle_distribution", "revenue_at_risk",
             "dormant_recovery", "cohort_sizes", "repeat_rate_trend", "delay_review_impact",
             "high_value_categories", "delay_retention", "state_ranking", "buyer_type_comparison",
             "repurchase_interval", "segment_lifecycle_matrix", "segment_top_categories"):
    query(_key)((lambda fn: lambda w: fn(w.mart()))(getattr(A, _key)))

for _key in ("pareto_bands", "pareto_80_threshold"):
    query(_key)((lambda fn: lambda w: fn(w.spend_ranking()))(getattr(A, _key)))

for _key in ("cohort_retention_matrix", "retention_by_period", "new_vs_returning"):
    query(_key)((lambda fn: lambda w: fn(w.active_months()))(getattr(A, _key)))

for _key in ("monthly_trend", "weekday_distribution"):
    query(_key)((lambda fn: lambda w: fn(w.fact()))(getattr(A, _key)))

# ---- 2.10 views --------------------------------------------------------------------------------
for _key in ("vw_kpi_executive", "vw_segment_summary", "vw_lifecycle_summary",
             "vw_risk_behavior", "vw_geographic_summary", "vw_customer_profile_distribution"):
    query(_key)((lambda fn: lambda w: fn(w.mart()))(getattr(V, _key)))
query("vw_pareto_revenue")(lambda w: V.vw_pareto_revenue(w.spend_ranking()))
query("vw_cohort_retention")(lambda w: V.vw_cohort_retention(w.active_months()))
query("vw_monthly_revenue_trend")(lambda w: V.vw_monthly_revenue_trend(w.fact()))

# ---- 2.2 profiling --------------------------------------------------------------------------------
from ..operators import profile as PO  # noqa: E402
from . import profiling as PR  # noqa: E402

for _key, _fn in (("profile_value_distribution", PR.value_distributions),
                  ("profile_top_values", PR.top_categories), ("profile_range_check", PR.range_checks),
                  ("profile_numeric_summary", PR.numeric_summaries),
                  ("profile_dimension_ranges", PR.dimension_ranges),
                  ("profile_sequence_violations", PR.sequence_violations),
                  ("profile_invalid_domain", PR.invalid_scores),
                  ("profile_line_number_stats", PR.line_number_stats),
                  ("profile_listing", PR.translation_listing)):
    query(_key)((lambda fn: lambda w: fn(w.raw_all()))(_fn))
# one stored count per key and value of each table answers these four; only the tables that a query reads are counted
for _key, _fn, _of in (("profile_distinct_counts", PR.distinct_counts, PR.DISTINCT_COLUMNS), ("profile_duplicate_keys", PR.duplicate_keys, PR.DUPLICATE_KEYS),
                       ("profile_multi_record_entities", PR.multi_payment_orders, ["payments"]), ("profile_key_overlap", PR.key_overlap, PR.OVERLAP_TABLES)):
    query(_key)((lambda fn, of: lambda w: fn(w.key_counts_of(of)))(_fn, _of))
# row count and NULL counts come from ONE written profile pass per table
query("profile_row_count")(lambda w: PR._union(PO.row_count_from_profile(p) for p in w.profiles().values()))
query("profile_null_counts")(lambda w: PR._union(PO.null_counts_from_profile(p) for p in w.profiles().values()))
query("profile_timestamp_range")(lambda w: PR._union(
    PO.timestamp_range_from_profile(w.profile(t), cols) for t, cols in PR.TIMESTAMPS.items()))
query("profile_exact_duplicates")(
    lambda w: PR.exact_duplicates_from_groups(w._parallel(list(w.raw_all()), w.row_groups)))

# ---- 2.3 cleaning operators, 2.4 cleaning checks, 2.6 fact checks ---------------------------------
from . import checks as CK  # noqa: E402

query("clean_reject_null_key")(CK.null_key_rejects)
query("clean_rule_cascade")(CK.rule_rejects)
query("clean_exact_dup_each_copy")(lambda w: CK.exact_duplicate_rejects(w, 1))
query("clean_exact_dup_grouped")(lambda w: CK.exact_duplicate_rejects(w, 2))
query("clean_dup_key_reject")(CK.dup_key_rejects)
query("clean_dup_key_flag")(CK.duplicate_flags)
query("clean_keep_first")(CK.kept_rows)
query("clean_distinct_rows")(CK.distinct_rows)
query("clean_bounds_reject")(lambda w: CK.rejects_with_reason(w, 1, "geolocation", "COORDINATES_%"))
query("clean_standardize_text")(CK.standardized_texts)
query("flag_timestamp_sequence")(lambda w: w.cleaned("orders"))
query("flag_missing_attributes")(lambda w: w.cleaned("products"))
query("flag_free_item")(lambda w: w.cleaned("order_items").filter(F.col("is_free_item") == 1).select(
    "order_id", "order_item_id", "product_id", "price", "is_free_item"))
query("flag_out_of_bounds")(lambda w: w.cleaned("geolocation"))
query("clean_summary")(CK.clean_summary)

query("check_row_accounting")(CK.row_accounting)
query("check_unique_key")(CK.unique_keys)
query("check_null_summary")(CK.null_summary)
query("check_reject_breakdown")(CK.reject_breakdown)
query("check_business_rules")(CK.business_rules)

query("check_fact_grain")(CK.fact_grain)
query("check_revenue_consistency")(CK.revenue_consistency)
query("check_fact_nulls")(CK.fact_nulls)
query("check_fact_ri_summary")(CK.fact_ri_summary)
query("dist_delivery_bucket")(CK.delivery_buckets)
query("dist_processing_bucket")(CK.processing_buckets)
query("fact_flag_totals")(CK.flag_totals)
query("fact_status_distribution")(CK.status_distribution)
query("fact_payment_stats")(CK.payment_stats)
query("fact_date_coverage")(CK.date_coverage)
query("fact_top_states")(CK.top_states)
query("fact_top_categories")(CK.top_categories)
query("dist_review_score")(CK.review_score_distribution)
query("dist_items_bucket")(CK.items_buckets)

# ---- 2.8 mart validation ----------------------------------------------------------------------------
from . import mart_checks as MC  # noqa: E402

for _key, _fn in (("check_mart_grain", MC.mart_grain), ("check_spend_consistency", MC.spend_consistency),
                  ("check_order_consistency", MC.order_consistency), ("check_mart_nulls", MC.mart_nulls),
                  ("rfm_score_distribution", MC.rfm_distribution), ("rfm_uniformity", MC.rfm_uniformity),
                  ("check_lifecycle_ranges", MC.lifecycle_ranges), ("check_retention_flags", MC.retention_flags),
                  ("cohort_distribution", MC.cohort_distribution), ("check_ratio_bounds", MC.ratio_bounds),
                  ("behaviour_summary", MC.behaviour_summary), ("segment_sanity", MC.segment_sanity),
                  ("lifecycle_spend", MC.lifecycle_spend), ("mart_top_states", MC.mart_top_states),
                  ("cohort_heatmap", MC.cohort_heatmap)):
    query(_key)(_fn)

# ---- 2.1 sources and sinks ----------------------------------------------------------------------------
from functools import reduce  # noqa: E402

from ..operators.schema import check_schema  # noqa: E402
from ..operators.tagged import json_text  # noqa: E402
from .warehouse import AUDIT_COLUMNS  # noqa: E402


def _union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("load_csv")
def _load_csv(w: Warehouse) -> DataFrame:
    """Every line of the nine files: loaded rows in the one format of all tables, and lines that were rejected, raw."""
    out = []
    for t, loaded in w.csv_loaded_all().items():
        out.append(loaded.rows.select(F.lit(t).alias("table_name"), F.lit("loaded").alias("status"), json_text(loaded.rows.columns).alias("line")))
        out.append(loaded.rejects.select(F.lit(t).alias("table_name"), F.lit("rejected").alias("status"), F.col("raw_line").alias("line")))
    return _union_all(out)


@query("load_row_counts")
def _load_row_counts(w: Warehouse) -> DataFrame:
    loaded = {t: x.rows for t, x in w.csv_loaded_all().items()}
    return _union_all(df.agg(F.count(F.lit(1)).alias("loaded_rows")).select(F.lit(t).alias("table_name"), "loaded_rows")
                      for t, df in loaded.items())


@query("materialize")
def _materialize(w: Warehouse) -> DataFrame:
    """CREATE TABLE AS: the per-order item aggregate, written by the warehouse and read back."""
    return w.order_agg("agg_order_items")


@query("append_rejects")
def _append_rejects(w: Warehouse) -> DataFrame:
    """The rejects of all tables and both generations as appended to the log by this run."""
    log = w.reject_log()
    return log.filter(F.col("run_id") == w.spark.sparkContext.applicationId).drop("run_id", "rejected_at")



@query("named_views")
def _named_views(w: Warehouse) -> DataFrame:
    """Every registered view, read by its name: rows and columns of each."""
    names = V.register_views(w.spark, w.fact(), w.mart(), w.dims(), w.spend_ranking(), w.active_months())
    return _union_all(w.spark.sql(f"SELECT '{v}' AS view_name, count(*) AS row_count, {len(w.spark.table(v).columns)} AS column_count FROM {v}")
                      for v in names)


@query("audit_timestamp")
def _audit_timestamp(w: Warehouse) -> DataFrame:
    """Audit columns as stored in all 38 audited tables (stamped at write time), read in one scan."""
    w.clean_both(), w.mart()
    names = [*w.cleaning_tables(), "fact_order_master", "mart_customer_features"]
    counts = w.count_stored(names, ", ".join(f"{c} timestamp" for c in AUDIT_COLUMNS), [],
                            {"total_rows": F.count(F.lit(1)), "audited_rows": F.count(F.coalesce(*AUDIT_COLUMNS))})
    of = w.spark.createDataFrame([(n,) for n in names], "table_name string")  # a table without rows has no group
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total_rows", "audited_rows")]
    return of.join(counts, "table_name", "left").select("table_name", *zero)


@query("check_schema")
def _check_schema(w: Warehouse) -> DataFrame:
    """Columns and types of the fact and the mart as stored, against the declared schemas, with rows and NULLs."""
    return _union_all([check_schema(w.fact(), "fact_order_master", FP.FACT_SCHEMA),
                       check_schema(w.mart(), "mart_customer_features", MP.MART_SCHEMA)])


@query("output_row_counts")
def _output_row_counts(w: Warehouse) -> DataFrame:
    """Rows of the cleaned and reject tables, the fact and the mart, as counted while they were written."""
    kept = (F.col("generation") == 2) | F.col("layer").isin("fact", "mart")
    return w.ledger().filter(kept & (F.col("measure") == "rows")).select("table_name", F.col("value").alias("row_count"))
