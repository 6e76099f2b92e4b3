"""Counts per key, identical rows by hash first, schemas as rows, and CSV lines that do not fit."""

import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.operators import clean as C
from souk.operators import counts as K
from souk.operators.schema import check_schema
from souk.plans.warehouse import warehouse
from souk.sources import csv as csv_io

from .conftest import SMALL


def test_key_counts_like_a_counter(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "a|b", None, "NULL"]), r.choice(["b|c", "c", None]), r.randrange(3)) for _ in range(400)] + [("hot", "x", 1)] * 200
    df = spark.createDataFrame(rows, "a string, b string, n int").repartition(5)
    keys = [["a"], ["a", "b"], ["n"]]
    counts = K.key_counts(df, keys).cache()
    got = {(x.key_columns, tuple(x["values"])): x.occurrences for x in counts.collect()}
    text = lambda v: None if v is None else str(v)
    want = Counter()
    for a, b, n in rows:
        want.update([("a", (a,)), ("a, b", (a, b)), ("n", (text(n),))])
    assert got == dict(want)
    assert {x.key_columns: x.distinct_count for x in K.distinct_counts(counts, keys).collect()} == {
        "a": 4, "a, b": len({x[:2] for x in rows if None not in x[:2]}), "n": 3}
    top = [(x.key_value, x.occurrences) for x in K.duplicate_keys(counts, ["a", "b"], 3).collect()]
    assert top[0] == ("hot|x", 200) and len(top) == 3
    several = [k for k, n in Counter(x[0] for x in rows).items() if n > 1]
    assert K.repeated_keys(counts, [["a"]]).first().keys_with_multiple_rows == len(several)
    assert K.repeated_keys(counts, [["a"]], with_null=False).first().keys_with_multiple_rows == len([k for k in several if k is not None])
    empty = K.key_counts(df.limit(0), keys)
    assert {x.distinct_count for x in K.distinct_counts(empty, keys).collect()} == {0} and K.duplicate_keys(empty, ["a"]).count() == 0


def test_one_scan_for_all_keys_of_a_table(spark):
    from souk.plans.profiling import raw_keys

    w = warehouse(spark, SMALL)
    plan = K.key_counts(w.raw("orders"), raw_keys("orders"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan


def groups(df, **kw):
    return sorted(((*x[:-1], x["_n"]) for x in C.row_groups(df, **kw).collect()), key=str)


def test_rows_with_one_hash_stay_apart(spark):
    rows = [("k1", 1), ("k1", 1), ("k1", 2), (None, 1), (None, 1), (None, None), ("k2", 2)] + [("hot", 9)] * 50
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    want = sorted(((*x, n) for x, n in Counter(rows).items()), key=str)
    assert groups(df) == want
    assert groups(df, row_hash=F.lit(7)) == want  # every row has the same hash
    assert groups(df, row_hash=F.when(F.col("v") == 1, 1).otherwise(2)) == want
    assert groups(df.limit(0)) == []


def test_rows_of_a_unique_hash_are_not_shuffled(spark):
    """With the repeated hashes written, their size is known, and the rows are joined where they are."""
    w = warehouse(spark, SMALL)
    w.row_groups("orders")
    plan = C.row_groups(w.raw("orders"), w.stored("row_hashes_orders"))._jdf.queryExecution().executedPlan().toString()
    single = plan.split("HashAggregate")[0]
    assert "BroadcastHashJoin" in single and "hashpartitioning" not in single


def test_schema_rows(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, None)], "a int, b string, c double")
    got = {r.column_name: tuple(r)[2:] for r in check_schema(df, "t", {"b": "string", "a": "bigint", "d": "int"}).collect()}
    assert got == {"b": (1, 2, "string", "string", 2, 1, False), "a": (2, 1, "bigint", "int", 2, 0, False),
                   "d": (3, None, "int", None, 2, None, False), "c": (None, 3, None, "double", 2, 2, False)}
    assert all(r.ok for r in check_schema(df, "t", dict(df.dtypes)).collect())
    assert all(r.ok and r.row_count == 0 for r in check_schema(df.limit(0), "t", dict(df.dtypes)).collect())


def test_lines_that_do_not_fit_become_rejects(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.DecimalType(5, 2)), T.StructField("t", T.TimestampNTZType())])
    lines = ["1,2.50,2020-01-01 10:00:00", "x,1.00,2020-01-01 10:00:00", "2,,", "3,abc,", "4,1.00", "5,1.00,2020-01-01 00:00:00,more", '6,"7.00",not a time']
    (tmp_path / "in.csv").write_text("id,n,t\n" + "".join(x + "\n" for x in lines))
    path = str(tmp_path / "lines")
    csv_io.read_csv(spark, str(tmp_path / "in.csv"), schema).write.parquet(path)
    loaded = csv_io.split(spark.read.parquet(path), schema)
    assert sorted(r.id for r in loaded.rows.collect()) == [1, 2]
    assert sorted(r.raw_line for r in loaded.rejects.collect()) == sorted([lines[1], *lines[3:]])
    assert loaded.rows.count() + loaded.rejects.count() == len(lines)


def test_nine_files_are_loaded_whole(spark):
    w = warehouse(spark, SMALL)
    for t, loaded in w.csv_loaded_all().items():
        good, bad = loaded.rows.count(), loaded.rejects.count()
        assert good + bad == w.raw(t).count() and bad == 0
        if t != "reviews":  # its texts hold line breaks
            files = spark.read.text(f"{w.root}/csv/{t}")
            heads = files.filter(F.col("value").startswith(w.raw(t).columns[0] + ",")).count()
            assert files.count() - heads == good, t
