"""Referential-integrity audit and one-row-per-key dimension views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import pct


def ri_check(name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """total, orphans and orphan % of a foreign key; NULL keys count as orphans.

    The child's rows are counted per key first (combined map-side), so a key
    that holds a third of the rows is one row of the join with the DISTINCT
    parent keys, and no child row can fan out.
    """
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct().withColumn("_hit", F.lit(1))
    counts = child.groupBy(F.col(child_key).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    joined = counts.join(keys, F.col("_ck") == F.col("_pk"), "left")
    total = F.coalesce(F.sum("_n"), F.lit(0))
    orphans = F.sum(F.when(F.col("_hit").isNull(), F.col("_n")).otherwise(0))
    return joined.agg(
        F.lit(name).alias("ri_check"),
        total.cast("bigint").alias("total_rows"),
        orphans.cast("bigint").alias("orphan_rows"),
        pct(orphans, total).alias("orphan_pct"),
    )


def dedupe(df: DataFrame, key: str, prefer: list[str], keep: list[str], unique_flag: str | None = None) -> DataFrame:
    """One row per non-NULL key: the smallest row by ``prefer`` then all other columns.

    The remaining columns make the choice deterministic; the reference's own
    tie-break (a load-constant timestamp) cannot.

    ``unique_flag`` names a 0/1 column that is 0 exactly when the key has a
    single row (the cleaning engine's ``duplicate_flag``).  Those rows pass
    straight through - no shuffle - and only flagged rows are reduced with
    ``min(struct(...))`` per key.  That aggregation is combined map-side, so
    a key with millions of rows is reduced before the shuffle (a keyed
    ROW_NUMBER window would sort them all in one task); it runs as a sort
    aggregate (struct buffers are not hash-aggregatable), which is why it is
    kept to the flagged minority.
    """
    rest = [c for c in df.columns if c != key and c not in prefer]
    order = prefer + rest
    rows = df.filter(F.col(key).isNotNull())
    out_cols = [key] + [c for c in keep if c != key]
    if unique_flag is not None:
        single = rows.filter(F.col(unique_flag) == 0).select(*out_cols)
        rows = rows.filter(F.col(unique_flag) != 0)
    best = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("_m"))
    chosen = best.select(key, *[F.col(f"_m.{c}").alias(c) for c in keep if c != key])
    return single.unionByName(chosen) if unique_flag is not None else chosen
