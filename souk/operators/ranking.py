"""Global (unpartitioned) ranking that scales: ROW_NUMBER, running SUM and NTILE of every row of a whole table
(``selection`` has tiles, percentiles and medians that need no ranking of all rows).

``Window.orderBy(...)`` without ``partitionBy`` plans ``Exchange SinglePartition``:
one task sorts the whole table.  Instead:

1. ``repartitionByRange`` over the sort key INCLUDING a unique tie-break deals the
   rows into ranges, and the range number is written with the rows to the
   shared folder, so a retried task cannot move a row to another range;
2. ``groupBy(range)`` gives a count and a sum per range; their prefix sums are the
   offsets, a table with one row per range, which bounds its broadcast;
3. ``row_number`` / running ``sum`` over ``partitionBy(range).orderBy(key)`` plus
   the range's offset.

Because the tie-break is part of the key, a value shared by a third of the
rows is still cut into many ranges.  NULL keys are ranked: first in ascending
order, last in descending order, as the window orders them.
The number of ranges is ``spark.sql.shuffle.partitions``: that setting bounds the rows of a task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


@dataclass
class SortKey:
    column: str
    descending: bool = False


def _keys(order) -> list[SortKey]:
    out = []
    for o in order:
        if isinstance(o, SortKey):
            out.append(o)
        elif isinstance(o, tuple):
            out.append(SortKey(o[0], o[1] == "desc"))
        else:
            out.append(SortKey(o))
    return out


def _sort_cols(keys: list[SortKey]) -> list[Column]:
    return [F.col(k.column).desc_nulls_last() if k.descending else F.col(k.column).asc_nulls_first() for k in keys]


@dataclass
class Ranked:
    df: DataFrame  # input columns + _bucket, written
    keys: list[SortKey]
    n: int
    counts: list[int]  # rows per range
    offsets: DataFrame  # _bucket, _rows_before, _sum_before: one row per range
    sum_col: str | None
    total_sum: object = None

    def _windowed(self) -> tuple[Window, DataFrame]:
        return Window.partitionBy("_bucket").orderBy(*_sort_cols(self.keys)), self.df.join(F.broadcast(self.offsets), "_bucket")

    def with_row_number(self, name: str = "row_number") -> DataFrame:
        w, rows = self._windowed()
        return rows.withColumn(name, F.row_number().over(w) + F.col("_rows_before")).drop("_rows_before", "_sum_before")

    def with_running_sum(self, name: str = "running_sum", rank_name: str = "row_number") -> DataFrame:
        w, rows = self._windowed()
        run = F.sum(self.sum_col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        before = F.col("_sum_before").cast(run_type(dict(self.df.dtypes)[self.sum_col]))
        rows = rows.withColumn(rank_name, F.row_number().over(w) + F.col("_rows_before"))
        return rows.withColumn(name, run + before).drop("_rows_before", "_sum_before")


def run_type(dtype: str) -> str:
    if dtype.startswith("decimal"):
        p, s = dtype[len("decimal("):-1].split(",")
        return f"decimal({min(38, int(p) + 10)},{s})"
    return "double" if dtype in ("float", "double") else "bigint"


def rank_buckets(df: DataFrame, order, tiebreak: list[str], sum_col: str | None = None, buckets: int | None = None) -> Ranked:
    """Deal the rows into ``buckets`` ranges (default ``spark.sql.shuffle.partitions``) of the total order ``order + tiebreak``."""
    spark = df.sparkSession
    keys = _keys(order) + [SortKey(t) for t in tiebreak]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_dir(spark)}/souk/{spark.sparkContext.applicationId}/ranking-{uuid.uuid4().hex[:12]}"
    df.repartitionByRange(buckets, *_sort_cols(keys)).withColumn("_bucket", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    kind = run_type(dict(df.dtypes)[sum_col]) if sum_col else "bigint"
    total = F.coalesce(F.sum(sum_col), F.lit(0)).cast(kind) if sum_col else F.lit(0).cast(kind)
    stats = sorted(placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("c"), total.alias("s")).collect(), key=lambda r: r["_bucket"])
    rows, before, s_before = [], 0, Decimal(0) if kind.startswith("decimal") else 0
    for r in stats:  # one row per range
        rows.append((r["_bucket"], before, s_before))
        before, s_before = before + r["c"], s_before + r["s"]
    offsets = spark.createDataFrame(rows, f"_bucket int, _rows_before bigint, _sum_before {kind}")
    return Ranked(placed, keys, before, [r["c"] for r in stats], offsets, sum_col, s_before)


def global_row_number(df, order, tiebreak, name="row_number", **kw) -> DataFrame:
    r = rank_buckets(df, order, tiebreak, **kw)
    return r.with_row_number(name).drop("_bucket")


def ntile_from_rank(rank: Column, n: int, k: int) -> Column:
    """NTILE(k) of the row at 1-based position ``rank`` among ``n`` rows (SQL semantics)."""
    q, r = divmod(n, k)
    first = (rank - 1) / F.lit(q + 1)
    big = F.floor(first).cast("bigint") + 1
    if q == 0:
        return big
    small = F.lit(r) + F.floor((rank - F.lit(r * (q + 1)) - 1) / F.lit(q)).cast("bigint") + 1
    return F.when(rank <= F.lit(r * (q + 1)), big).otherwise(small)


def global_ntile(df, k: int, order, tiebreak, name="ntile", **kw) -> DataFrame:
    r = rank_buckets(df, order, tiebreak, **kw)
    out = r.with_row_number("_rn")
    return out.withColumn(name, ntile_from_rank(F.col("_rn"), r.n, k)).drop("_rn", "_bucket")
