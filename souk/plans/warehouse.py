"""Layered tables of one input directory: raw -> cleaned/rejects -> fact -> mart.

Written layers (``materialize``, the CREATE TABLE AS of the reference) live
under the folder the session names in ``spark.checkpoint.dir`` - a shared
filesystem on a cluster - so later stages and every query read a table
instead of recomputing its lineage, and a lost executor only costs the
tasks of the stage that is running.  One Warehouse per (application,
input directory); tables are built lazily on first use.

Every table is counted while it is written: its rows and a few sums are observed on top of the
plan, in the stage that writes, where Spark counts each task once whatever is retried.  The
counts of all tables are the ledger, a small table that the accounting checks read instead of the layers.
"""

from __future__ import annotations

import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import CleanResult
from ..operators.counts import key_counts
from ..session import checkpoint_dir
from ..sources import csv as csv_io, fixtures, schemas
from . import analytics, cleaning, fact as fact_plan, mart as mart_plan, profiling

GENERATIONS = {1: "keep_first", 2: "flag"}
AUDIT_COLUMNS = ["cleaned_at", "rejected_at", "fact_created_at", "mart_created_at"]
MANY_KEYS = 50  # from one key in so many rows that repeats, only whole rows tell rows apart without shuffling them
LEDGER = "table_name string, layer string, generation bigint, dataset string, measure string, value bigint"

_LOCK = threading.RLock()
_CACHE: dict[tuple[str, str], "Warehouse"] = {}


def materialize(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str] | None = None,
                bucket_by: str | None = None, table: str | None = None, audit_col: str | None = None,
                full: bool = False, observe: tuple[Observation, list[Column]] | None = None) -> DataFrame:
    """Full refresh of a table (DROP + CREATE AS): overwrite, then read back.

    ``bucket_by`` writes an external bucketed table (files under ``path``,
    registered as ``table``): tables bucketed on the same unique key with the
    same bucket count join without any shuffle, and a non-bucketed partner is
    shuffled once to match.  Only one-row-per-key tables are bucketed, so no
    bucket can hold a hot key.
    """
    cols = df.columns
    if audit_col:  # stamped when the table is written (DEFAULT CURRENT_TIMESTAMP)
        df = audit(df, audit_col)
    if observe:
        df = df.observe(observe[0], *observe[1])
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        w.bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", path).saveAsTable(table)
        back = spark.table(table)
    else:
        w.parquet(path)
        back = spark.read.parquet(path)
    return back if full else back.select(*cols)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]
        self.root = f"{checkpoint_dir(spark)}/souk/{spark.sparkContext.applicationId}/{tag}"
        self.table_prefix = "souk_" + hashlib.sha1(self.root.encode()).hexdigest()[:10]
        self._tables: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}  # as written, audit column included
        self._locks: dict[str, threading.Lock] = {}
        self._clean: dict[tuple[str, str], CleanResult] = {}
        self._counts: dict[str, dict[str, int]] = {}  # table -> measure -> value, as written
        self._spend = None

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with _LOCK:
            if key not in _CACHE:
                _CACHE[key] = cls(spark, sf_dir)
            return _CACHE[key]

    def _table(self, name: str, build, partition_by=None, bucket_by=None, audit_col=None, sums: dict[str, str] | None = None) -> DataFrame:
        """``sums``: columns whose sums are observed beside the rows, by the name of the measure."""
        with _LOCK:
            if name in self._tables:
                return self._tables[name]
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:  # one builder per table; other tables build concurrently
            if name not in self._tables:
                df = build()
                measures = [F.count(F.lit(1)).alias("rows")] + [
                    F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).alias(m) for m, c in (sums or {}).items() if c in df.columns]
                seen = Observation()
                stored = materialize(self.spark, df, f"{self.root}/{name}", partition_by, bucket_by,
                                     f"{self.table_prefix}_{name}", audit_col, full=True, observe=(seen, measures))
                # an empty plan may be written without the node that counts
                self._counts[name] = dict(seen.get) or stored.agg(*measures).first().asDict()
                self._stored[name] = stored
                self._tables[name] = stored.select(*df.columns)
        return self._tables[name]

    def stored(self, name: str) -> DataFrame:
        """A written layer as stored, audit column included."""
        return self._stored[name]

    def _parallel(self, names, fn) -> dict[str, DataFrame]:
        """Materialise independent tables concurrently: Spark schedules the jobs
        submitted from several driver threads side by side."""
        names = list(names)
        with ThreadPoolExecutor(max_workers=min(8, len(names))) as pool:
            return dict(zip(names, pool.map(fn, names)))

    # raw inputs: derived once from the driver tables and written (the load step);
    # profiling, both cleaning generations and the accounting checks read them
    def raw(self, name: str) -> DataFrame:
        return self._table(f"raw_{name}", lambda: fixtures.RAW_BUILDERS[name](self.spark, self.sf_dir))

    def raw_all(self) -> dict[str, DataFrame]:
        return self._parallel(fixtures.RAW_BUILDERS, self.raw)

    def cleaning(self, name: str, mode: str = "flag") -> CleanResult:
        key = (name, mode)
        with _LOCK:
            if key in self._clean:
                return self._clean[key]
        from ..operators.clean import clean

        specs = cleaning.gen2_specs() if mode == "flag" else cleaning.gen1_specs()
        # inputs are materialised without the global lock, so other tables build meanwhile
        result = clean(self.raw(name), specs[name], mode, groups=self.row_groups(name))
        with _LOCK:
            return self._clean.setdefault(key, result)

    def profile(self, name: str) -> DataFrame:
        """One-pass profile of a raw table (row count + per-column NULL counts), written as 1 row."""
        from ..operators.profile import table_profile

        return self._table(f"profile_{name}", lambda: table_profile(self.raw(name), name))

    def profiles(self) -> dict[str, DataFrame]:
        return self._parallel(list(fixtures.RAW_BUILDERS), self.profile)

    def row_groups(self, name: str) -> DataFrame:
        """Identical-row groups of a raw table, written once for both generations and both outputs."""
        from ..operators.clean import key_hash, row_groups, row_hashes

        def build():
            raw, key = self.raw(name), cleaning.group_key(name)
            by = key_hash(key) if key else None
            repeated = self._table(f"row_hashes_{name}", lambda: row_hashes(raw, by))
            if key and self._counts[f"row_hashes_{name}"]["rows"] * MANY_KEYS > self._counts[f"raw_{name}"]["rows"]:
                by, repeated = None, self._table(f"whole_row_hashes_{name}", lambda: row_hashes(raw))
            return row_groups(raw, repeated, by, alone=by is not None)

        return self._table(f"row_groups_{name}", build)

    def key_counts(self, name: str) -> DataFrame:
        """Rows per key and value of a raw table, all its keys in one scan, stored."""
        return self._table(f"key_counts_{name}", lambda: key_counts(self.raw(name), profiling.raw_keys(name)))

    def key_counts_of(self, names) -> dict[str, DataFrame]:
        return self._parallel(names, self.key_counts)

    def unique_key_counts(self, name: str, mode: str, key: list[str]) -> DataFrame:
        """Rows per key of a cleaned table, stored."""
        return self._table(f"key_counts_{'g1_' if mode == GENERATIONS[1] else ''}cleaned_{name}", lambda: key_counts(self.cleaned(name, mode), [key]))

    def cleaned(self, name: str, mode: str = "flag") -> DataFrame:
        prefix = "cleaned" if mode == "flag" else "g1_cleaned"
        flag = "is_out_of_bounds" if name == "geolocation" else "duplicate_flag"
        return self._table(f"{prefix}_{name}", lambda: self.cleaning(name, mode).cleaned, audit_col="cleaned_at", sums={"flagged": flag})

    def rejects(self, name: str, mode: str = "flag") -> DataFrame:
        prefix = "rejects" if mode == "flag" else "g1_rejects"
        return self._table(f"{prefix}_{name}", lambda: self.cleaning(name, mode).rejects, audit_col="rejected_at", sums={"represented": "rejected_row_count"})

    def cleaned_all(self, mode: str = "flag") -> dict[str, DataFrame]:
        return self._parallel(fixtures.RAW_BUILDERS, lambda n: self.cleaned(n, mode))

    def rejects_all(self, mode: str = "flag") -> dict[str, DataFrame]:
        return self._parallel(fixtures.RAW_BUILDERS, lambda n: self.rejects(n, mode))

    def clean_both(self) -> None:
        """Both cleaning generations of all tables, side by side."""
        self._parallel([(n, kind, mode) for mode in GENERATIONS.values() for n in fixtures.RAW_BUILDERS for kind in ("cleaned", "rejects")],
                       lambda x: getattr(self, x[1])(x[0], x[2]))

    def cleaning_tables(self) -> dict[str, tuple[str, int, str]]:
        """Written table -> (layer, generation, dataset) of the 36 cleaned and reject tables."""
        return {f"{'g1_' if gen == 1 else ''}{layer}_{t}": (layer, gen, t) for gen in GENERATIONS for layer in ("cleaned", "rejects")
                for t in fixtures.RAW_BUILDERS}

    def count_stored(self, names: list[str], schema: str, by: list[str], counts: dict[str, Column]) -> DataFrame:
        """``counts`` per table and ``by`` over the columns of ``schema`` of written tables, in one scan; a column
        that a table lacks is NULL.  Rows are counted per file first, so the table's name is derived once per file."""
        files = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/{n}" for n in names])
        tag = self.root.rsplit("/", 1)[1]
        of_file = files.groupBy(F.col("_metadata.file_path").alias("_file"), *by).agg(*[c.alias(n) for n, c in counts.items()])
        name = F.split_part(F.split_part(F.col("_file"), F.lit(f"/{tag}/"), F.lit(2)), F.lit("/"), F.lit(1))
        return of_file.groupBy(name.alias("table_name"), *by).agg(*[F.sum(n).alias(n) for n in counts])

    def rejects_both(self) -> None:
        """Rejects of both cleaning generations of all tables, side by side."""
        self._parallel([(n, mode) for mode in GENERATIONS.values() for n in fixtures.RAW_BUILDERS], lambda x: self.rejects(*x))

    def cleaning_ledger(self) -> DataFrame:
        """The part of the ledger that tells of the cleaning: raw, cleaned and reject tables, without fact and mart."""
        def build():
            self.clean_both()
            tables = {f"raw_{t}": ("raw", None, t) for t in fixtures.RAW_BUILDERS} | self.cleaning_tables()
            return self.spark.createDataFrame([(n, *t, m, v) for n, t in tables.items() for m, v in self._counts[n].items()], LEDGER)

        return self._table("cleaning_ledger", build)

    def ledger(self) -> DataFrame:
        """Counts of every written layer, one row per table and measure, collected while the tables were written."""
        def build():
            self.clean_both()
            self.fact(), self.mart()
            tables = {f"raw_{t}": ("raw", None, t) for t in fixtures.RAW_BUILDERS} | self.cleaning_tables()
            tables |= {"fact_order_master": ("fact", None, "fact_order_master"), "mart_customer_features": ("mart", None, "mart_customer_features")}
            return self.spark.createDataFrame([(n, *t, m, v) for n, t in tables.items() for m, v in self._counts[n].items()], LEDGER)

        return self._table("ledger", build)

    def reject_reasons(self) -> DataFrame:
        """Reject rows by table and reason: the part of the ledger that has no fixed number of measures, counted once."""
        def build():
            self.rejects_both()
            names = {n: t for n, t in self.cleaning_tables().items() if t[0] == "rejects"}
            of = self.spark.createDataFrame([(n, gen, t) for n, (_, gen, t) in names.items()], "table_name string, generation bigint, dataset string")
            counts = self.count_stored(list(names), "reject_reason string", ["reject_reason"], {"cnt": F.count(F.lit(1))})
            return counts.join(F.broadcast(of), "table_name").select("generation", "dataset", "reject_reason", "cnt")  # 18 names

        return self._table("reject_reasons", build)

    def reject_log(self, run_id: str | None = None) -> DataFrame:
        """All rejects of both generations appended to the log as the rows of one run; the same run again replaces its rows."""
        from ..operators.tagged import replace_run

        run_id = run_id or self.spark.sparkContext.applicationId
        with _LOCK:
            lock = self._locks.setdefault("reject_log", threading.Lock())
        with lock:
            self.rejects_both()
            by = [(gen, t) for gen in GENERATIONS for t in fixtures.RAW_BUILDERS]
            rows = None
            for gen, t in by:
                one = cleaning.tagged(self.rejects(t, GENERATIONS[gen]), gen, t, ("reject_reason", "rejected_row_count"))
                rows = one if rows is None else rows.unionByName(one)
            partitions = self.spark.createDataFrame(by, "generation bigint, table_name string")
            return replace_run(audit(rows, "rejected_at"), f"{self.root}/reject_log", run_id, partitions)

    def dim(self, name: str) -> DataFrame:
        """A one-row-per-key dimension.  Not bucketed: a join on a foreign key shuffles both sides,
        so Spark can split the partition of a popular value."""
        table, _ = fact_plan.DIMENSIONS[name]
        return self._table(name, lambda: fact_plan.dimension_views({table: self.cleaned(table)})[name]())

    def dims(self) -> dict[str, DataFrame]:
        return self._parallel(list(fact_plan.DIMENSIONS), self.dim)

    def order_agg(self, name: str) -> DataFrame:
        """One of the five per-order aggregate tables feeding the fact."""
        needed = {"agg_order_items": ["order_items"], "agg_order_dominant_category": ["order_items"],
                  "agg_order_dominant_seller": ["order_items"], "agg_order_payments": ["payments"],
                  "agg_order_reviews": ["reviews"]}[name]
        dims = {"agg_order_dominant_category": {"dim_products": lambda: self.dim("dim_products")},
                "agg_order_dominant_seller": {"dim_sellers": lambda: self.dim("dim_sellers")}}.get(name, {})
        return self._table(name, lambda: fact_plan.order_aggregates(
            {t: self.cleaned(t) for t in needed}, {k: v() for k, v in dims.items()},
            {t: self.hot_orders(t) for t in needed})[name](), bucket_by="order_id")

    def hot_orders(self, name: str) -> DataFrame | None:
        """Orders with more rows of a cleaned table than one task should hold, None if there is none."""
        hot = self._table(f"hot_orders_{name}", lambda: fact_plan.hot_orders(self.cleaned(name)))
        return hot if self._counts[f"hot_orders_{name}"]["rows"] else None

    def order_aggs(self) -> dict[str, DataFrame]:
        return self._parallel(["agg_order_items", "agg_order_dominant_category", "agg_order_dominant_seller",
                               "agg_order_payments", "agg_order_reviews"], self.order_agg)

    def payment_agg(self) -> DataFrame:
        return self.order_agg("agg_order_payments")

    def threshold(self) -> DataFrame:
        return self._table("hv_threshold", lambda: fact_plan.high_value_threshold(self.payment_agg()))

    def fact(self) -> DataFrame:
        def build():
            needed = [n for n in fixtures.RAW_BUILDERS if n != "geolocation"]
            cleaned = self._parallel(needed, self.cleaned)
            dims = self.dims()
            aggs = self.order_aggs()  # the five aggregates side by side, then the threshold over one of them
            return fact_plan.build_fact(cleaned, self.threshold(), aggs, dims)

        return self._table("fact_order_master", build, partition_by=["order_year"], audit_col="fact_created_at")

    def mart(self) -> DataFrame:
        def build():
            mat = lambda df, name: self._table(name, lambda: df, bucket_by="customer_unique_id")
            return mart_plan.build_mart(self.fact(), materialize=mat, parallel=self._parallel)

        return self._table("mart_customer_features", build, bucket_by="customer_unique_id",
                           audit_col="mart_created_at")

    def spend_ranking(self):
        """Customers ranked by spend, ranked once for the Pareto answers and view."""
        with _LOCK:
            lock = self._locks.setdefault("spend_ranking", threading.Lock())
        with lock:
            if self._spend is None:
                self._spend = analytics.spend_ranking(self.mart())
        return self._spend

    def active_months(self) -> DataFrame:
        """One bitmap of active months per customer."""
        return self._table("customer_active_months", lambda: analytics.active_months(self.purchases()), bucket_by="customer_unique_id")

    def purchases(self) -> DataFrame:
        """Customer and time of every order: two columns of the fact, from orders and customers alone where it is not built yet."""
        if "fact_order_master" in self._tables:
            return self.fact().select("customer_unique_id", "order_purchase_timestamp")

        def build():
            orders = self._parallel(["orders", "customers"], self.cleaned)["orders"]
            return fact_plan.purchases(orders, self.dim("dim_customers"))

        return self._table("purchases", build)

    def csv_loaded(self, name: str) -> csv_io.Loaded:
        """Raw table unloaded to CSV in the shared folder once, then loaded back with the declared schema (the
        reference's load step): good rows, and lines that do not fit the schema."""
        def build():
            path = f"{self.root}/csv/{name}"
            csv_io.write_csv(self.raw(name), path)
            return csv_io.read_csv(self.spark, path, schemas.RAW_SCHEMAS[name], free_text=name == "reviews")

        return csv_io.split(self._table(f"csv_lines_{name}", build), schemas.RAW_SCHEMAS[name])

    def build_all(self) -> None:
        """Materialise every layer, independent tables side by side."""
        self.raw_all()
        self.clean_both()
        self.mart()

    def csv_loaded_all(self) -> dict[str, csv_io.Loaded]:
        return self._parallel(fixtures.RAW_BUILDERS, self.csv_loaded)

    def customer_agg(self) -> DataFrame:
        self.mart()
        return self._tables["customer_agg"]

    def preferred(self, kind: str) -> DataFrame:
        self.mart()
        return self._tables[{"category": "customer_preferred_cat", "day": "customer_preferred_day"}[kind]]

    def ref_date(self) -> DataFrame:
        return mart_plan.reference_date(self.fact())


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.get(spark, sf_dir)


def audit(df: DataFrame, column: str) -> DataFrame:
    """Audit column (cleaned_at, fact_created_at, ...) stamped when a table is written."""
    return df.withColumn(column, F.current_timestamp())
