"""What is shuffled: rows alone with their key are not, per-order measures are dealt by order once."""

from decimal import Decimal

from pyspark.sql import functions as F

from souk.operators import clean as C
from souk.plans import cleaning, fact as FP, mart as MP

ITEMS = ("order_id string, order_item_id int, product_id string, seller_id string, price decimal(12,2), freight_value decimal(12,2), "
         "is_free_item int, duplicate_flag int")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


def _items(spark):
    rows = [("a", 1, "p", "s", 1, None, 0, 1), ("a", 1, "p", "s", 1, None, 0, 1), ("a", 2, "q", "s", 2, 1, 0, 0), ("b", 1, None, None, 0, 1, 1, 0),
            (None, 1, "p", "s", 5, 1, 0, 0)] + [("hot", i, f"p{i % 5}", f"s{i % 3}", 3, 1, 0, 0) for i in range(60)]
    money = lambda x: None if x is None else Decimal(x)
    return spark.createDataFrame([(*r[:4], money(r[4]), money(r[5]), *r[6:]) for r in rows], ITEMS)


def test_rows_alone_with_their_key_are_not_shuffled(spark):
    rows = [("1", "x"), ("2", "x"), ("2", "y"), ("3", "z"), ("3", "z"), (None, "n"), (None, "n"), (None, "m"), ("4", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    for mode in ("flag", "keep_first"):
        spec = C.CleanSpec("t", key=["k"], null_reason="NULL_K", dup_key=["k"], dup_reason="DUPLICATE_K")
        for h, alone in ((C.key_hash(["k"]), {"1", "4"}), (F.xxhash64(F.lit(7)), set())):  # the second: all keys share a hash
            groups = C.row_groups(df, row_hash=h, alone=True)
            assert {r.k for r in groups.filter(C.ALONE).collect()} == alone
            got, want = C.clean(df, spec, mode, groups), C.clean(df, spec, mode)
            assert got.cleaned.columns == want.cleaned.columns and got.rejects.columns == want.rejects.columns
            assert _rows(got.cleaned) == _rows(want.cleaned) and _rows(got.rejects) == _rows(want.rejects)


def test_group_keys_are_no_finer_than_those_of_generation_1():
    for t, spec in cleaning.gen1_specs().items():
        key = cleaning.group_key(t)
        assert not spec.dup_key or spec.dup_key == key or (t == "category_translation" and key == [f"lower(trim({spec.dup_key[0]}))"])


def test_items_are_dealt_by_order_once(spark):
    items = _items(spark)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(FP.agg_order_items(items, None, True))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_hot_orders_go_through_the_general_steps(spark):
    items = _items(spark)
    hot = FP.hot_orders(items, 10)
    assert [r.order_id for r in hot.collect()] == ["hot"]
    want = _rows(FP.agg_order_items(items))
    assert want == _rows(FP.agg_order_items(items, None, True)) == _rows(FP.agg_order_items(items, hot, True))
    dim = spark.createDataFrame([("p", "cat"), ("p1", "x"), ("p2", "y"), ("p3", "y")], "product_id string, product_category_name string")
    of = lambda **kw: _rows(FP.agg_dominant_category(items, None, dim, **kw))
    assert of() == of(dealt=True) == of(hot=hot, dealt=True)
    sellers = spark.createDataFrame([("s", "SP"), ("s1", "RJ")], "seller_id string, seller_state string")
    of = lambda **kw: _rows(FP.agg_dominant_seller_state(items, None, sellers, **kw))
    assert of() == of(dealt=True) == of(hot=hot, dealt=True)


def test_customer_measures_are_shuffled_without_the_category(spark):
    from souk.plans.warehouse import warehouse

    from .conftest import SMALL

    plan = _plan(MP.customer_agg(warehouse(spark, SMALL).fact(), MP.reference_date(warehouse(spark, SMALL).fact()).first()[0]))
    wide = [ln for ln in plan.splitlines() if "HashAggregate(keys=[customer_unique_id" in ln and "delivered" in ln]
    assert wide and not any("dominant_category" in ln.split("functions=")[0] for ln in wide)


def test_cleaning_answers_do_not_build_the_mart(spark, tmp_path):
    """Rows of accounting and summary are known when the cleaning tables are written."""
    from souk.plans import checks as CK
    from souk.plans.warehouse import Warehouse

    from .conftest import SMALL

    w = Warehouse(spark, SMALL + "/")
    w.root, w.table_prefix = str(tmp_path / "w" / "tag"), "souk_volume_test"
    assert CK.clean_summary(w).count() == 9 and not {"fact_order_master", "mart_customer_features"} & set(w._tables)


def test_retention_answers_build_orders_and_customers_alone(spark, tmp_path):
    """The bitmaps are those of the whole fact, from the two tables that they need."""
    from souk.plans import analytics as A
    from souk.plans.catalog import QUERIES
    from souk.plans.warehouse import Warehouse, warehouse

    from .conftest import SMALL

    w = Warehouse(spark, SMALL + "/")
    w.root, w.table_prefix = str(tmp_path / "w" / "tag"), "souk_retention_test"
    rows = _rows(QUERIES["cohort_retention_matrix"](w))
    assert {n for n in w._tables if n.startswith("raw_")} == {"raw_orders", "raw_customers"} and "fact_order_master" not in w._tables
    fact = warehouse(spark, SMALL).fact()
    assert rows == _rows(A.cohort_retention_matrix(A.active_months(fact)))
    assert _rows(w.active_months()) == _rows(A.active_months(fact))
    assert _rows(w.purchases()) == _rows(fact.select("customer_unique_id", "order_purchase_timestamp"))


def test_profiles_count_the_keys_of_the_tables_they_read(spark, tmp_path):
    from souk.plans.catalog import QUERIES
    from souk.plans.warehouse import Warehouse

    from .conftest import SMALL

    w = Warehouse(spark, SMALL + "/")
    w.root = str(tmp_path / "w" / "tag")
    counted = lambda: {n for n in w._tables if n.startswith("key_counts_")}
    assert QUERIES["profile_multi_record_entities"](w).count() == 1 and counted() == {"key_counts_payments"}
    assert QUERIES["profile_key_overlap"](w).count() == 10 and not counted() & {"key_counts_geolocation", "key_counts_category_translation"}


def test_unloaded_csv_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    from souk.sources import csv as csv_io

    monkeypatch.setattr(csv_io, "ROWS_PER_FILE", 50, raising=False)
    odd = ["  padded ", 'say "x", y', None, "two\nlines", "plain"]
    df = spark.createDataFrame([(i, odd[i % 5]) for i in range(220)] + [(None, "n")], "k bigint, s string").coalesce(1)
    csv_io.write_csv(df, str(tmp_path / "out"))
    files = [f.name for f in (tmp_path / "out").glob("part-*")]
    assert len(files) == 5 and all(f.endswith(".csv.gz") for f in files)
    lines = csv_io.read_csv(spark, str(tmp_path / "out"), df.schema, free_text=True)
    assert _rows(lines) == _rows(df.withColumn("_bad_line", F.lit(None)))
