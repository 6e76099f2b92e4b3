"""DuckDB oracle SQL for the profiling keys (plain per-table SQL, UNION ALL)."""

from ..plans import profiling as PR
from ..sources import schemas
from .analytics_sql import out

Q: dict[str, str] = {}


def _u(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _cols(t):
    return [f.name for f in schemas.RAW_SCHEMAS[t].fields]


def _key(cols) -> str:
    return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in cols) + ")"


TABLES = list(schemas.RAW_SCHEMAS)

Q["profile_row_count"] = out(_u(f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM raw_{t}" for t in TABLES),
                             bigints=["total_rows"])
Q["profile_null_counts"] = out(_u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_count "
    f"FROM raw_{t}" for t in TABLES for c in _cols(t)), bigints=["null_count"])
Q["profile_distinct_counts"] = out(_u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM raw_{t}"
    for t, cols in PR.DISTINCT_COLUMNS.items() for c in cols), bigints=["distinct_count"])


def _dups(t, keys):
    g = (f"SELECT '{t}' AS table_name, {_key(keys)} AS key_value, count(*) AS occurrences FROM raw_{t} "
         f"GROUP BY {', '.join(keys)} HAVING count(*) > 1")
    if t in PR.UNLIMITED_DUPLICATE_LIST:
        return f"SELECT * FROM ({g})"
    return (f"SELECT table_name, key_value, occurrences FROM (SELECT *, row_number() OVER "
            f"(ORDER BY occurrences DESC, key_value ASC) AS rn FROM ({g})) WHERE rn <= 20")


Q["profile_duplicate_keys"] = out(_u(_dups(t, k) for t, k in PR.DUPLICATE_KEYS.items()), bigints=["occurrences"])
Q["profile_exact_duplicates"] = out(_u(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM (SELECT {', '.join(_cols(t))} FROM raw_{t} "
    f"GROUP BY ALL HAVING count(*) > 1)) AS exact_duplicate_groups" for t in TABLES),
    bigints=["exact_duplicate_groups"])
Q["profile_value_distribution"] = out(_u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS cnt "
    f"FROM raw_{t} GROUP BY {c}" for t, c in PR.DISTRIBUTIONS), bigints=["cnt"])
Q["profile_top_values"] = out(
    "SELECT CAST(product_category_name AS VARCHAR) AS value, count(*) AS cnt FROM raw_products "
    "GROUP BY product_category_name ORDER BY cnt DESC, product_category_name ASC NULLS FIRST LIMIT 20",
    bigints=["cnt"])
Q["profile_range_check"] = out(_u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, "
    f"CAST(MAX({c}) AS DOUBLE) AS max_value, SUM(CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 ELSE 0 END) AS out_of_range "
    f"FROM raw_{t}" for t, c, lo, hi in PR.RANGES), bigints=["out_of_range"])
Q["profile_numeric_summary"] = out(_u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
    f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_count, SUM(CASE WHEN {c} <= 0 THEN 1 ELSE 0 END) AS non_positive, "
    f"SUM(CASE WHEN {c} < 0 THEN 1 ELSE 0 END) AS negative, SUM(CASE WHEN {c} < 1 THEN 1 ELSE 0 END) AS below_one, "
    f"CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, "
    f"CAST(ROUND(CAST(AVG({c}) AS DECIMAL(38,{s + 4})), 2) AS DOUBLE) AS avg_value FROM raw_{t}"
    for t, c, s in PR.NUMERIC), bigints=["total_rows", "null_count", "non_positive", "negative", "below_one"])
Q["profile_dimension_ranges"] = out(_u(
    f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, "
    f"SUM(CASE WHEN {c} <= 0 THEN 1 ELSE 0 END) AS non_positive FROM raw_products" for c in PR.DIMENSIONS),
    bigints=["non_positive"])
Q["profile_timestamp_range"] = _u(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, MIN({c}) AS min_value, MAX({c}) AS max_value FROM raw_{t}"
    for t, cols in PR.TIMESTAMPS.items() for c in cols)
_steps = list(zip(PR.ORDER_STEPS, PR.ORDER_STEPS[1:]))
Q["profile_sequence_violations"] = out(_u(
    f"SELECT '{a} > {b}' AS check_name, SUM(CASE WHEN {a} > {b} THEN 1 ELSE 0 END) AS violations FROM raw_orders"
    for a, b in _steps), bigints=["violations"])
Q["profile_invalid_domain"] = out(
    f"SELECT 'reviews' AS table_name, 'review_score' AS column_name, count(*) AS invalid_rows FROM raw_reviews "
    f"WHERE review_score NOT BETWEEN {PR.SCORE_MIN} AND {PR.SCORE_MAX} OR review_score IS NULL", bigints=["invalid_rows"])
Q["profile_multi_record_entities"] = out(
    "SELECT count(DISTINCT order_id) AS entities_with_multiple_rows FROM "
    "(SELECT order_id FROM raw_payments GROUP BY order_id HAVING count(*) > 1)",
    bigints=["entities_with_multiple_rows"])
Q["profile_line_number_stats"] = out(
    "SELECT MAX(order_item_id) AS max_line_number, "
    "CAST(ROUND(CAST(AVG(order_item_id) AS DECIMAL(38,4)), 4) AS DOUBLE) AS avg_line_number FROM raw_order_items",
    bigints=["max_line_number"])
Q["profile_key_overlap"] = out(_u(
    f"SELECT '{k}' AS key_name, '{t}' AS table_name, count(DISTINCT {c}) AS distinct_keys FROM raw_{t}"
    for k, pairs in PR.KEY_OVERLAP.items() for t, c in pairs), bigints=["distinct_keys"])
Q["profile_listing"] = "SELECT product_category_name, product_category_name_english FROM raw_category_translation"
