"""CSV load/unload with declared schemas (the reference's COPY ... (HEADER, DELIMITER ',', NULL '')).

Columns bind by POSITION to the declared schema (the header row is skipped,
its names are not trusted), an empty field is NULL, quoted fields may hold
commas and doubled quotes.  Newlines inside a field are read only for tables with
free text (``free_text``): such files cannot be split, all others are read in
parallel.  A line with a malformed field, or with too few or too many fields, becomes a reject with its raw text; it never becomes a
silent NULL and does not stop the load (``load_csv`` stops, for files that must be whole).
Never ``inferSchema``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_LINE = "_bad_line"
ROWS_PER_FILE = 1_000_000

CSV_READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",  # bind by position, like COPY without a column list
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "sep": ",",
    "mode": "FAILFAST",
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",  # keep padding: cleaning must see it
    "ignoreTrailingWhiteSpace": "false",
}


def load_csv(spark: SparkSession, path: str, schema: T.StructType, free_text: bool = False) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_READ_OPTIONS, multiLine=free_text).csv(path)


@dataclass
class Loaded:
    rows: DataFrame  # lines that fit the schema
    rejects: DataFrame  # raw_line of those that do not


def read_csv(spark: SparkSession, path: str, schema: T.StructType, free_text: bool = False) -> DataFrame:
    """All lines: the declared columns, and ``_bad_line`` with the raw text of a line that does not fit, NULL else.

    To be written before it is split: Spark does not read the raw text alone from a CSV file."""
    lines = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    options = CSV_READ_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    return spark.read.schema(lines).options(**options, multiLine=free_text).csv(path)


def split(lines: DataFrame, schema: T.StructType) -> Loaded:
    bad = F.col(BAD_LINE).isNotNull()
    return Loaded(lines.filter(~bad).select(*schema.names), lines.filter(bad).select(F.col(BAD_LINE).alias("raw_line")))


def write_csv(df: DataFrame, path: str) -> None:
    """Gzip files of a bounded number of rows each: one is read by one task."""
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS, compression="gzip", maxRecordsPerFile=ROWS_PER_FILE).csv(path)
