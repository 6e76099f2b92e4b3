"""Counts of rows per key, for all keys of a table in one scan.

Each row gives one (key columns, values) pair per key of interest, which is counted in one hash
aggregation (combined map-side, so a value held by most rows is one row per task).  The stored
counts answer distinct counts, duplicate keys, entities with several rows and key overlaps
without another scan.  Values are kept apart as an array of texts with NULLs, so the keys
('a|b', 'c') and ('a', 'b|c') stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_name(cols: list[str]) -> str:
    return ", ".join(cols)


def key_counts(df: DataFrame, keys: list[list[str]]) -> DataFrame:
    """(key_columns, values array<string>, occurrences) of every key and value."""
    pairs = [F.struct(F.lit(key_name(k)).alias("key_columns"), F.array(*[F.col(c).cast("string") for c in k]).alias("values")) for k in keys]
    rows = df.select(F.explode(F.array(*pairs)).alias("k"))
    return rows.groupBy("k.key_columns", "k.values").agg(F.count(F.lit(1)).alias("occurrences"))


def key_text() -> Column:
    """The values joined by |, NULL written out."""
    return F.array_join("values", "|", "NULL")


def distinct_counts(counts: DataFrame, keys: list[list[str]]) -> DataFrame:
    """(key_columns, distinct_count): distinct values without NULL, 0 for a table without rows."""
    known = ~F.exists("values", lambda v: v.isNull())
    wide = counts.agg(*[F.count(F.when((F.col("key_columns") == key_name(k)) & known, 1)).alias(f"d{i}") for i, k in enumerate(keys)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(key_name(k)).alias("key_columns"), F.col(f"d{i}").alias("distinct_count")) for i, k in enumerate(keys)])))


def repeated(counts: DataFrame, keys: list[list[str]]) -> DataFrame:
    return counts.filter(F.col("key_columns").isin([key_name(k) for k in keys]) & (F.col("occurrences") > 1))


def duplicate_keys(counts: DataFrame, key: list[str], top: int | None = 20) -> DataFrame:
    """(key_value, occurrences) of keys seen more than once, the most frequent first (the key breaks ties)."""
    g = repeated(counts, [key]).select("key_columns", key_text().alias("key_value"), "occurrences")
    if top is None:
        return g.drop("key_columns")
    w = Window.partitionBy("key_columns").orderBy(F.col("occurrences").desc(), F.col("key_value"))
    return g.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= top).drop("_rn", "key_columns")


def repeated_keys(counts: DataFrame, keys: list[list[str]], with_null: bool = True) -> DataFrame:
    """(key_columns, keys_with_multiple_rows); without ``with_null`` a key that holds a NULL is no entity."""
    r = repeated(counts, keys)
    if not with_null:
        r = r.filter(~F.exists("values", lambda v: v.isNull()))
    return r.groupBy("key_columns").agg(F.count(F.lit(1)).alias("keys_with_multiple_rows"))
