"""Derive the nine raw commerce inputs from the driver's TPC-H-style tables.

The driver tables are clean (no NULLs, no identical rows), so the mapping
below injects the dirt the cleaning rules must catch, using fixed arithmetic
on the keys (FIXTURES.md).  Every variant row (identical copies, conflicting
keys, case variants) comes from ONE scan of the source: each source row
explodes into a small array of variant tags, so no table is re-read per
variant.  The DuckDB oracle writes the same mapping with UNION ALL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one input table.

    A source that arrives as fewer splits than the cluster has cores (one
    big row group, a handful of files) would run all map-side work in that
    many tasks; it is spread with a hash repartition on its key first.  Inputs
    with enough splits - every large one - are left untouched.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    want = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want and name not in SMALL_DIMENSIONS:
        # hash on the table's key: deterministic on retry, no sort needed
        df = df.repartition(want, df.columns[0])
    return df


# fixed-size TPC-H dimensions (25 nations, 5 regions): never worth spreading
SMALL_DIMENSIONS = {"nation", "region"}


def _variants(df: DataFrame, *conditions: str) -> DataFrame:
    """Explode each row into tag 0 plus tag i for every true condition i.

    A plain array with NULL for false conditions, exploded and filtered:
    everything stays in generated code (no lambda evaluation per row).
    """
    parts = ["0"] + [f"if({c}, {i}, null)" for i, c in enumerate(conditions, start=1)]
    return df.withColumn("v", F.explode(F.expr(f"array({', '.join(parts)})"))).filter(F.col("v").isNotNull())


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is the fixed 25-row TPC-H dimension: its size does not grow with sf
    n = F.broadcast(driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    base = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    df = _variants(base, "k % 500 = 1", "k % 1500 = 1", "k % 701 = 2").selectExpr(
        "CASE WHEN k % 983 = 0 THEN NULL ELSE concat('C', k) END AS customer_id",
        "CASE WHEN o_custkey % 3 = 0 THEN concat('S', k) ELSE concat('U', o_custkey) END AS customer_unique_id",
        "CASE WHEN k % 811 = 0 THEN 99 ELSE 1000 + (c_custkey * 37) % 98000 END AS customer_zip_code_prefix",
        "CASE WHEN v = 3 THEN 'other' ELSE concat('  ', c_mktsegment, ' ') END AS customer_city",
        "concat(' ', lower(n_name)) AS customer_state",
    )
    return _conform(df, schemas.CUSTOMERS)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_orderstatus", "o_orderdate"
    )
    base = o.selectExpr(
        "k",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
        "ELSE CASE WHEN k % 2 = 0 THEN 'cancelled' ELSE 'processing' END END AS status",
        "o_orderdate + make_dt_interval(0, CAST(k % 24 AS INT)) AS ts",
    )
    df = _variants(base, "k % 750 = 3", "k % 1500 = 3", "k % 900 = 4").selectExpr(
        "CASE WHEN k % 997 = 0 THEN NULL ELSE concat('O', k) END AS order_id",
        "concat('C', k) AS customer_id",
        "CASE WHEN v = 3 THEN 'processing' ELSE status END AS order_status",
        "ts AS order_purchase_timestamp",
        "CASE WHEN k % 53 = 0 THEN NULL WHEN k % 211 = 0 THEN ts - make_dt_interval(1) "
        "ELSE ts + make_dt_interval(CAST(k % 12 AS INT)) END AS order_approved_at",
        "CASE WHEN status IN ('delivered', 'shipped') "
        "THEN ts + make_dt_interval(CAST(8 + k % 9 AS INT)) END AS order_delivered_carrier_date",
        "CASE WHEN status = 'delivered' "
        "THEN ts + make_dt_interval(CAST(5 + k % 60 AS INT), 5) END AS order_delivered_customer_date",
        "ts + make_dt_interval(25) AS order_estimated_delivery_date",
    )
    return _conform(df, schemas.ORDERS)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax", "l_shipdate"
    )
    df = _variants(li, "l_orderkey % 700 = 1").selectExpr(
        "CASE WHEN l_orderkey % 997 = 0 THEN NULL WHEN l_orderkey % 613 = 5 THEN concat('X', l_orderkey) "
        "ELSE concat('O', l_orderkey) END AS order_id",
        "l_linenumber AS order_item_id",
        "concat('P', l_partkey) AS product_id",
        "concat('V', l_suppkey) AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "CASE (l_orderkey + l_partkey) % 499 WHEN 0 THEN NULL "
        "WHEN 1 THEN -CAST(l_extendedprice AS DECIMAL(12,2)) WHEN 2 THEN CAST(0 AS DECIMAL(12,2)) "
        "ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS price",
        "CASE l_partkey % 333 WHEN 5 THEN CAST(-1 AS DECIMAL(12,2)) WHEN 6 THEN NULL "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) "
        "END AS freight_value",
    )
    return _conform(df, schemas.ORDER_ITEMS)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = (
        driver_table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderpriority")
        .filter("k % 50 <> 7")
    )
    df = _variants(o, "k % 7 = 0", "k % 800 = 9").selectExpr(
        "CASE WHEN k % 997 = 0 THEN NULL WHEN k % 613 = 6 THEN concat('X', k) ELSE concat('O', k) END AS order_id",
        "CASE WHEN v = 1 THEN 2 ELSE 1 END AS payment_sequential",
        "CASE WHEN v = 1 THEN 'voucher' WHEN k % 401 = 0 THEN 'crypto' WHEN k % 401 = 1 THEN NULL "
        "WHEN o_orderpriority = '1-URGENT' THEN 'credit_card' WHEN o_orderpriority = '2-HIGH' THEN 'boleto' "
        "WHEN o_orderpriority = '3-MEDIUM' THEN 'voucher' ELSE 'debit_card' END AS payment_type",
        "CASE WHEN k % 307 = 0 THEN 0 ELSE 1 + k % 10 END AS payment_installments",
        "CASE WHEN v = 1 THEN CAST(10.00 AS DECIMAL(12,2)) WHEN k % 601 = 0 THEN CAST(0 AS DECIMAL(12,2)) "
        "WHEN k % 601 = 1 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS payment_value",
    )
    return _conform(df, schemas.PAYMENTS)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    df = _variants(p, "p_partkey % 400 = 1", "p_partkey % 450 = 2").selectExpr(
        "CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE concat('P', p_partkey) END AS product_id",
        "CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE concat('  ', p_type, ' ') END AS product_category_name",
        "length(p_name) AS product_name_length",
        "10 * p_size AS product_description_length",
        "1 + p_partkey % 6 AS product_photos_qty",
        "CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE p_size * 100 + CASE WHEN v = 2 THEN 1 ELSE 0 END "
        "END AS product_weight_g",
        "p_size AS product_length_cm",
        "1 + p_partkey % 20 AS product_height_cm",
        "1 + p_partkey % 30 AS product_width_cm",
    )
    return _conform(df, schemas.PRODUCTS)


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = F.broadcast(driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    base = s.join(n, s.s_nationkey == n.n_nationkey)
    df = _variants(base, "s_suppkey % 50 = 1", "s_suppkey % 60 = 2").selectExpr(
        "CASE WHEN s_suppkey % 97 = 0 THEN NULL ELSE concat('V', s_suppkey) END AS seller_id",
        "1000 + (s_suppkey * 41) % 98000 AS seller_zip_code_prefix",
        "CASE WHEN v = 2 THEN 'other' ELSE concat(' City', s_nationkey) END AS seller_city",
        "concat(' ', lower(n_name)) AS seller_state",
    )
    return _conform(df, schemas.SELLERS)


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = (
        driver_table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("k"), "o_orderdate")
        .filter("k % 3 <> 0")
    )
    base = o.selectExpr(
        "k",
        "o_orderdate",
        "CASE WHEN k % 419 = 0 THEN 9 WHEN k % 419 = 1 THEN NULL ELSE 1 + (k * 7) % 5 END AS score",
    )
    df = _variants(base, "k % 800 = 5", "k % 650 = 7").selectExpr(
        "CASE WHEN k % 991 = 0 THEN NULL ELSE concat('R', k - k % 2) END AS review_id",
        "concat('O', k) AS order_id",
        "CASE WHEN v = 2 THEN CASE WHEN score = 1 THEN 2 ELSE 1 END ELSE score END AS review_score",
        "CASE WHEN k % 2 = 0 THEN NULL ELSE ' t ' END AS review_comment_title",
        "' msg ' AS review_comment_message",
        "o_orderdate + make_dt_interval(30) AS review_creation_date",
        "o_orderdate + make_dt_interval(32) AS review_answer_timestamp",
    )
    return _conform(df, schemas.REVIEWS)


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    df = _variants(c, "c_custkey % 100 = 1", "c_custkey % 120 = 2").selectExpr(
        "1000 + (c_custkey * 37) % 98000 AS geolocation_zip_code_prefix",
        "CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 83 = 0 THEN 12.5 "
        "ELSE -33 + (c_custkey * 13 % 380) / 10.0 END AS geolocation_lat",
        "-73 + (c_custkey * 17 % 380) / 10.0 AS geolocation_lng",
        "CASE WHEN v = 2 THEN upper(c_mktsegment) ELSE lower(c_mktsegment) END AS geolocation_city",
        "concat('n', c_nationkey) AS geolocation_state",
    )
    return _conform(df, schemas.GEOLOCATION)


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = driver_table(spark, sf_dir, "part").select(F.col("p_type")).distinct()
    translated = types.filter("p_type <> 'PROMO'").selectExpr(
        "p_type AS product_category_name", "concat('en_', lower(p_type)) AS product_category_name_english"
    )
    small_copy = translated.filter("product_category_name = 'SMALL'")
    extra = spark.createDataFrame(
        [(None, "none"), (" large ", "en_big")], schemas.CATEGORY_TRANSLATION
    )
    return _conform(translated.unionByName(small_copy).unionByName(extra), schemas.CATEGORY_TRANSLATION)


RAW_BUILDERS = {
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "products": raw_products,
    "sellers": raw_sellers,
    "reviews": raw_reviews,
    "geolocation": raw_geolocation,
    "category_translation": raw_category_translation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
