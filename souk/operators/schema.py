"""A table's columns against an expected schema, as rows, with the counts of one pass over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_schema(df: DataFrame, table: str, expected: dict[str, str]) -> DataFrame:
    """One row per column that is expected or stored: position, expected and stored type, rows, NULLs and ``ok``.

    A column is ok if it is stored at the expected position with the expected type.  A missing column has no stored type and
    no count of NULLs, an unexpected one no expected type.  ``expected`` has each column's type in order.  ``df`` is read as stored; nothing but its schema and one
    aggregation over it enters the result.
    """
    stored = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)}
    wanted = {c: (i, kind) for i, (c, kind) in enumerate(expected.items(), 1)}
    names = [*wanted, *(c for c in stored if c not in wanted)]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(f"n{i}") for i, c in enumerate(names) if c in stored])
    text = lambda v: F.lit(v).cast("string")
    rows = []
    for i, c in enumerate(names):
        (place, kind), (at, want) = stored.get(c, (None, None)), wanted.get(c, (None, None))
        rows.append(F.struct(text(c).alias("column_name"), F.lit(at).cast("bigint").alias("expected_position"), F.lit(place).cast("bigint").alias("stored_position"),
                             text(want).alias("expected_type"), text(kind).alias("stored_type"), F.col("rows").alias("row_count"),
                             (F.col(f"n{i}") if c in stored else F.lit(None).cast("bigint")).alias("null_count"), F.lit((place, kind) == (at, want)).alias("ok")))
    return counts.select(F.inline(F.array(*rows))).select(F.lit(table).alias("table_name"), "*")
