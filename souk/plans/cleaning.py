"""Per-table cleaning specifications for both generations.

Generation 2 (``mode='flag'``) is what the order fact consumes; generation 1
(``mode='keep_first'``) is kept as a mode.  Every rule predicate is written
with its own guard, exactly as the rule states it, so three-valued logic
matches: e.g. a payment with NULL type is neither rejected nor cleaned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.clean import CleanResult, CleanSpec, clean, flag_missing, flag_sequence
from ..operators.tagged import tagged_rows

# ---- fixed values (must equal the reference's literals) ----------------------
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
LAT_MIN, LAT_MAX = "-33.75", "5.27"
LNG_MIN, LNG_MAX = "-73.99", "-34.79"
# -----------------------------------------------------------------------------

_TYPES = ", ".join(f"'{t}'" for t in PAYMENT_TYPES)
_PAY_VALUE_OK = "payment_value IS NOT NULL AND payment_value > 0"

_ORDER_SEQUENCE = flag_sequence(["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                                 "order_delivered_customer_date"])
_CATEGORY_MISSING = flag_missing(["product_category_name"])
_DIMENSIONS_MISSING = flag_missing(["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"])
_OUT_OF_BOUNDS = (
    f"CASE WHEN geolocation_lat NOT BETWEEN {LAT_MIN} AND {LAT_MAX} "
    f"OR geolocation_lng NOT BETWEEN {LNG_MIN} AND {LNG_MAX} THEN 1 ELSE 0 END"
)


def _spec(name, **kw):
    return CleanSpec(name=name, **kw)


def gen2_specs() -> dict[str, CleanSpec]:
    return {
        "customers": _spec(
            "customers", key=["customer_id"], null_reason="NULL_CUSTOMER_ID", dup_key=["customer_id"],
            normalise={"customer_city": "lower", "customer_state": "upper"},
        ),
        "orders": _spec(
            "orders", key=["order_id"], null_reason="NULL_ORDER_ID", dup_key=["order_id"],
            flags=[("timestamp_sequence_flag", _ORDER_SEQUENCE)],
        ),
        "order_items": _spec(
            "order_items", key=["order_id"], null_reason="NULL_ORDER_ID",
            rules=[
                ("INVALID_PRICE_NULL_OR_NEGATIVE", "price IS NULL OR price < 0"),
                ("INVALID_FREIGHT_NEGATIVE",
                 "(price IS NOT NULL AND price >= 0) AND (freight_value IS NOT NULL AND freight_value < 0)"),
            ],
            valid="price IS NOT NULL AND price >= 0 AND (freight_value IS NULL OR freight_value >= 0)",
            dup_key=["order_id", "order_item_id"],
            flags=[("is_free_item", "CASE WHEN price = 0 THEN 1 ELSE 0 END")],
        ),
        "payments": _spec(
            "payments", key=["order_id"], null_reason="NULL_ORDER_ID",
            rules=[
                ("INVALID_PAYMENT_VALUE_ZERO_OR_NEGATIVE", "payment_value IS NULL OR payment_value <= 0"),
                ("INVALID_PAYMENT_TYPE", f"{_PAY_VALUE_OK} AND payment_type NOT IN ({_TYPES})"),
                ("INVALID_INSTALLMENTS_LESS_THAN_ONE",
                 f"{_PAY_VALUE_OK} AND payment_type IN ({_TYPES}) "
                 "AND (payment_installments IS NULL OR payment_installments < 1)"),
            ],
            valid=f"{_PAY_VALUE_OK} AND payment_type IN ({_TYPES}) "
                  "AND payment_installments IS NOT NULL AND payment_installments >= 1",
            dup_key=["order_id", "payment_sequential"],
        ),
        "products": _spec(
            "products", key=["product_id"], null_reason="NULL_PRODUCT_ID", dup_key=["product_id"],
            normalise={"product_category_name": "lower"},
            flags=[("category_missing_flag", _CATEGORY_MISSING), ("dimensions_missing_flag", _DIMENSIONS_MISSING)],
        ),
        "sellers": _spec(
            "sellers", key=["seller_id"], null_reason="NULL_SELLER_ID", dup_key=["seller_id"],
            normalise={"seller_city": "lower", "seller_state": "upper"},
        ),
        "reviews": _spec(
            "reviews", key=["review_id"], null_reason="NULL_REVIEW_ID",
            rules=[("INVALID_REVIEW_SCORE_OUT_OF_RANGE", "review_score IS NULL OR review_score NOT BETWEEN 1 AND 5")],
            valid="review_score BETWEEN 1 AND 5",
            dup_key=["review_id", "order_id"],
            normalise={"review_comment_title": "trim", "review_comment_message": "trim"},
        ),
        "geolocation": _spec(
            "geolocation", normalise={"geolocation_city": "lower", "geolocation_state": "upper"},
            flags=[("is_out_of_bounds", _OUT_OF_BOUNDS)], duplicate_flag=False,
        ),
        "category_translation": _spec(
            "category_translation", key=["product_category_name"], null_reason="NULL_CATEGORY_NAME",
            dup_key=["lower(trim(product_category_name))"],
            normalise={"product_category_name": "lower", "product_category_name_english": "lower"},
        ),
    }


def gen1_specs() -> dict[str, CleanSpec]:
    return {
        "customers": _spec(
            "customers", key=["customer_id"], null_reason="NULL_CUSTOMER_ID", dup_key=["customer_id"],
            dup_reason="DUPLICATE_CUSTOMER_ID", normalise={"customer_city": "lower", "customer_state": "upper"},
        ),
        "orders": _spec(
            "orders", key=["order_id"], null_reason="NULL_ORDER_ID", dup_key=["order_id"],
            dup_reason="DUPLICATE_ORDER_ID", flags=[("timestamp_sequence_flag", _ORDER_SEQUENCE)],
        ),
        "order_items": _spec(
            "order_items", key=["order_id"], null_reason="NULL_ORDER_ID",
            rules=[
                ("INVALID_PRICE_ZERO_OR_NEGATIVE", "price IS NULL OR price <= 0"),
                ("INVALID_FREIGHT_NEGATIVE",
                 "(price IS NOT NULL AND price > 0) AND (freight_value IS NOT NULL AND freight_value < 0)"),
            ],
            valid="price IS NOT NULL AND price > 0 AND (freight_value IS NULL OR freight_value >= 0)",
        ),
        "payments": _spec(
            "payments", key=["order_id"], null_reason="NULL_ORDER_ID",
            rules=gen2_specs()["payments"].rules, valid=gen2_specs()["payments"].valid,
        ),
        "products": _spec(
            "products", key=["product_id"], null_reason="NULL_PRODUCT_ID", dup_key=["product_id"],
            dup_reason="DUPLICATE_PRODUCT_ID", normalise={"product_category_name": "lower"},
            flags=[("category_missing_flag", _CATEGORY_MISSING), ("dimensions_missing_flag", _DIMENSIONS_MISSING)],
        ),
        "sellers": _spec(
            "sellers", key=["seller_id"], null_reason="NULL_SELLER_ID", dup_key=["seller_id"],
            dup_reason="DUPLICATE_SELLER_ID", normalise={"seller_city": "lower", "seller_state": "upper"},
        ),
        "reviews": _spec(
            "reviews", key=["review_id"], null_reason="NULL_REVIEW_ID",
            rules=gen2_specs()["reviews"].rules, valid=gen2_specs()["reviews"].valid,
        ),
        "geolocation": _spec(
            "geolocation",
            rules=[("COORDINATES_OUTSIDE_BRAZIL_BOUNDS",
                    f"geolocation_lat < {LAT_MIN} OR geolocation_lat > {LAT_MAX} "
                    f"OR geolocation_lng < {LNG_MIN} OR geolocation_lng > {LNG_MAX}")],
            valid=f"geolocation_lat BETWEEN {LAT_MIN} AND {LAT_MAX} AND geolocation_lng BETWEEN {LNG_MIN} AND {LNG_MAX}",
            normalise={"geolocation_city": "lower", "geolocation_state": "upper"},
            dedup_all_rows=True, normalise_before_distinct=True,
        ),
        "category_translation": _spec(
            "category_translation", key=["product_category_name"], null_reason="NULL_CATEGORY_NAME",
            dup_key=["product_category_name"], dup_reason="DUPLICATE_CATEGORY_NAME",
            normalise={"product_category_name": "lower", "product_category_name_english": "lower"},
        ),
    }


def group_key(table: str) -> list[str] | None:
    """Key (SQL expressions) by whose hash a raw table's rows are told apart, None for whole rows: that of generation 2.
    Rows with equal keys in generation 1 have equal ones here."""
    return gen2_specs()[table].dup_key


def row_key(table: str) -> list[str]:
    """Columns that name a row of the table in tagged form (geolocation has no key: the zip prefix)."""
    spec = gen2_specs()[table]
    return spec.dup_key if spec.dup_key and all(k.isidentifier() for k in spec.dup_key) else spec.key or ["geolocation_zip_code_prefix"]


def tagged(df: DataFrame, generation: int, table: str, extra: tuple[str, ...] = (), values: list[str] | None = None) -> DataFrame:
    """Rows of a cleaned or reject table in the one format of all tables; ``values`` are the columns in JSON, all others by default."""
    return tagged_rows(df, generation, table, row_key(table), values or [c for c in df.columns if c not in extra], extra)


def clean_all(raw: dict[str, DataFrame], mode: str = "flag") -> dict[str, CleanResult]:
    specs = gen2_specs() if mode == "flag" else gen1_specs()
    return {name: clean(df, specs[name], mode) for name, df in raw.items()}
