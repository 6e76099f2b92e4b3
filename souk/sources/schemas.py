"""Declared schemas of the nine raw inputs (never inferred).

Column order is the load order: CSV files bind columns by position.
"""

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)
DIM = T.DecimalType(10, 2)
COORD = T.DecimalType(18, 8)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMERS = _struct(
    ("customer_id", S),
    ("customer_unique_id", S),
    ("customer_zip_code_prefix", I),
    ("customer_city", S),
    ("customer_state", S),
)

ORDERS = _struct(
    ("order_id", S),
    ("customer_id", S),
    ("order_status", S),
    ("order_purchase_timestamp", TS),
    ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS),
    ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
)

ORDER_ITEMS = _struct(
    ("order_id", S),
    ("order_item_id", I),
    ("product_id", S),
    ("seller_id", S),
    ("shipping_limit_date", TS),
    ("price", MONEY),
    ("freight_value", MONEY),
)

PAYMENTS = _struct(
    ("order_id", S),
    ("payment_sequential", I),
    ("payment_type", S),
    ("payment_installments", I),
    ("payment_value", MONEY),
)

PRODUCTS = _struct(
    ("product_id", S),
    ("product_category_name", S),
    ("product_name_length", I),
    ("product_description_length", I),
    ("product_photos_qty", I),
    ("product_weight_g", MONEY),
    ("product_length_cm", DIM),
    ("product_height_cm", DIM),
    ("product_width_cm", DIM),
)

SELLERS = _struct(
    ("seller_id", S),
    ("seller_zip_code_prefix", I),
    ("seller_city", S),
    ("seller_state", S),
)

REVIEWS = _struct(
    ("review_id", S),
    ("order_id", S),
    ("review_score", I),
    ("review_comment_title", S),
    ("review_comment_message", S),
    ("review_creation_date", TS),
    ("review_answer_timestamp", TS),
)

GEOLOCATION = _struct(
    ("geolocation_zip_code_prefix", I),
    ("geolocation_lat", COORD),
    ("geolocation_lng", COORD),
    ("geolocation_city", S),
    ("geolocation_state", S),
)

CATEGORY_TRANSLATION = _struct(
    ("product_category_name", S),
    ("product_category_name_english", S),
)

RAW_SCHEMAS = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "reviews": REVIEWS,
    "geolocation": GEOLOCATION,
    "category_translation": CATEGORY_TRANSLATION,
}

TABLES = list(RAW_SCHEMAS)
