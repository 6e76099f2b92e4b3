"""Mode (most frequent value) and latest-by per entity, as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dominant(df: DataFrame, entity: str, value: str, name: str | None = None) -> DataFrame:
    """Most frequent ``value`` per ``entity``; ties go to the alphabetically first value.

    Count per (entity, value) first - a hash aggregation combined map-side,
    so an entity with a huge number of rows shrinks to one row per distinct
    value before anything is sorted - then ``row_number() = 1`` over the
    counts per entity (Spark inserts a partial WindowGroupLimit before the
    shuffle).  NULL values take part like any other value.
    """
    name = name or value
    counts = df.groupBy(entity, value).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(entity).orderBy(F.col("_c").desc(), F.col(value).asc_nulls_first())
    best = counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return best.select(entity, F.col(value).alias(name))


def latest_by(df: DataFrame, entity: str, when: str, ties: list[str], cols: list[str], latest: DataFrame | None = None) -> DataFrame:
    """Columns of the row with the greatest ``when`` per entity; of several, the greatest ``ties``.

    ``latest`` may hold the greatest ``when`` per entity already, under the same names.  A timestamp or number is
    kept in a fixed-width buffer, so that maximum is a hash aggregation; then only rows that reach it are
    ordered, one per entity but for ties.  An entity whose ``when`` is always NULL keeps its greatest ``ties``.
    """
    latest = latest if latest is not None else df.groupBy(entity).agg(F.max(when).alias(when))
    top = latest.select(F.col(entity).alias("_entity"), F.col(when).alias("_when"))
    reached = df.join(top, (F.col(entity) == F.col("_entity")) & F.col(when).eqNullSafe(F.col("_when")))
    order = Window.partitionBy(entity).orderBy(*[F.col(t).desc() for t in ties], *[F.col(c).desc() for c in cols])
    return reached.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") == 1).select(entity, *cols)
