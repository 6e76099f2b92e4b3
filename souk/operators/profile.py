"""Data profiling operators: pure functions of a DataFrame plus a column list.

Counts that fit one aggregation (row count, NULL counts, min/max, rule
counts) are fused into ONE pass per table; the resulting single wide row is
turned into long form (one row per column) with ``stack`` - on one row, so
the reshaping costs nothing.  What needs counts per value (distinct counts, duplicate keys,
overlaps) is in ``counts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import avg_dec, count_if


def _stack(df: DataFrame, ids: list[str], pairs: list[tuple[str, str]], name: str, value: str) -> DataFrame:
    """Unpivot one wide row: pairs of (label, column)."""
    args = ", ".join(f"'{label}', `{c}`" for label, c in pairs)
    return df.selectExpr(*[f"`{i}`" for i in ids], f"stack({len(pairs)}, {args}) AS ({name}, {value})")


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """ONE aggregation pass (a 1-row frame): row count, the NULL count of every
    column, and min/max of every timestamp column."""
    ts_cols = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[count_if(F.col(c).isNull()).alias(f"null__{c}") for c in df.columns],
                  *[F.min(c).alias(f"min__{c}") for c in ts_cols],
                  *[F.max(c).alias(f"max__{c}") for c in ts_cols]) \
        .withColumn("table_name", F.lit(table))


def timestamp_range_from_profile(profile: DataFrame, cols: list[str]) -> DataFrame:
    parts = [f"'{c}', `min__{c}`, `max__{c}`" for c in cols]
    return profile.selectExpr("table_name",
                              f"stack({len(cols)}, {', '.join(parts)}) AS (column_name, min_value, max_value)")


def row_count_from_profile(profile: DataFrame) -> DataFrame:
    return profile.select("table_name", "total_rows")


def null_counts_from_profile(profile: DataFrame) -> DataFrame:
    pairs = [(c[len("null__"):], c) for c in profile.columns if c.startswith("null__")]
    return _stack(profile, ["table_name"], pairs, "column_name", "null_count")


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(table).alias("table_name"), "total_rows")


def null_counts(df: DataFrame, table: str, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    wide = df.agg(*[count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    wide = wide.withColumn("table_name", F.lit(table))
    return _stack(wide, ["table_name"], [(c, f"n{i}") for i, c in enumerate(cols)], "column_name", "null_count")


def key_string(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def exact_duplicate_groups(df: DataFrame, table: str) -> DataFrame:
    """Number of GROUPS of identical rows with more than one member (NULLs group together)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).alias("exact_duplicate_groups")).select(
        F.lit(table).alias("table_name"), "exact_duplicate_groups")


def value_distribution(df: DataFrame, table: str, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
        F.col(col).cast("string").alias("value"), "cnt")


def top_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    return g.orderBy(F.col("cnt").desc(), F.col(col).asc_nulls_first()).limit(n).select(
        F.col(col).cast("string").alias("value"), "cnt")


def range_check(df: DataFrame, table: str, col: str, lo, hi) -> DataFrame:
    c = F.col(col)
    return df.agg(
        F.min(c).cast("double").alias("min_value"), F.max(c).cast("double").alias("max_value"),
        count_if((c < F.lit(lo)) | (c > F.lit(hi))).alias("out_of_range"),
    ).select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"), "min_value", "max_value",
             "out_of_range")


def numeric_summary(df: DataFrame, table: str, col: str, scale: int) -> DataFrame:
    c = F.col(col)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(c.isNull()).alias("null_count"),
        count_if(c <= 0).alias("non_positive"),
        count_if(c < 0).alias("negative"),
        count_if(c < 1).alias("below_one"),
        F.min(c).cast("double").alias("min_value"),
        F.max(c).cast("double").alias("max_value"),
        avg_dec(c, 2, in_scale=scale).cast("double").alias("avg_value"),
    ).select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"), "*")


def dimension_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).cast("double").alias(f"mn{i}"), F.max(c).cast("double").alias(f"mx{i}"),
                 count_if(F.col(c) <= 0).alias(f"np{i}")]
    wide = df.agg(*aggs)
    parts = [f"'{c}', mn{i}, mx{i}, np{i}" for i, c in enumerate(cols)]
    return wide.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) AS (column_name, min_value, max_value, non_positive)")


def timestamp_range(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
    wide = df.agg(*aggs).withColumn("table_name", F.lit(table))
    parts = [f"'{c}', mn{i}, mx{i}" for i, c in enumerate(cols)]
    return wide.selectExpr("table_name", f"stack({len(cols)}, {', '.join(parts)}) AS (column_name, min_value, max_value)")


def sequence_violations(df: DataFrame, ordered: list[str]) -> DataFrame:
    """Rows where an earlier step is after the next one, per adjacent pair (both non-NULL), one pass."""
    pairs = list(zip(ordered, ordered[1:]))
    wide = df.agg(*[count_if(F.col(a) > F.col(b)).alias(f"v{i}") for i, (a, b) in enumerate(pairs)])
    return _stack(wide, [], [(f"{a} > {b}", f"v{i}") for i, (a, b) in enumerate(pairs)], "check_name", "violations")


def invalid_domain(df: DataFrame, table: str, col: str, lo, hi) -> DataFrame:
    c = F.col(col)
    return df.agg(count_if(~c.between(lo, hi) | c.isNull()).alias("invalid_rows")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"), "invalid_rows")


def line_number_stats(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).cast("bigint").alias("max_line_number"),
                  avg_dec(col, 4, in_scale=0).cast("double").alias("avg_line_number"))
