"""Rows of tables with different columns in one format, and a partitioned log of them.

A tagged row is (generation, table_name, key_value, row_values): the key as text and
all (or chosen) columns as one JSON object of texts, so rows of nine tables are one DataFrame.

``replace_run`` is an append that may be repeated: rows are written to the partitions of their run, and
only those partitions are replaced (dynamic partition overwrite).  Each partition gets a header row, so a run
that has no row for a table any more also replaces what an earlier attempt of the same run left there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import key_string

HEADER = "header"


def json_text(cols: list[str]) -> Column:
    """The columns as a JSON object of texts, NULLs kept."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]), {"ignoreNullFields": "false"})


def tagged_rows(df: DataFrame, generation: int, table: str, key: list[str], values: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(F.lit(generation).cast("bigint").alias("generation"), F.lit(table).alias("table_name"),
                     key_string(key).alias("key_value"), *extra, json_text(values).alias("row_values"))


def replace_run(rows: DataFrame, path: str, run_id: str, partitions: DataFrame) -> DataFrame:
    """Write ``rows`` to ``path`` as the rows of ``run_id`` and return the whole log.

    ``partitions`` has one row per partition of the run (the partition columns only); the log is partitioned by
    ``run_id`` and those columns.  Header rows are left out of what is returned.
    """
    by = partitions.columns
    headers = partitions.withColumn("kind", F.lit(HEADER))
    log = rows.withColumn("kind", F.lit("row")).unionByName(headers, allowMissingColumns=True).withColumn("run_id", F.lit(run_id))
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", *by).parquet(path)
    spark = rows.sparkSession
    back = spark.read.schema(log.schema).parquet(path)
    return back.filter(F.col("kind") != HEADER).select("run_id", *rows.columns)
