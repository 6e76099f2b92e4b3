"""Edge cases of the custom operators on tiny literal frames (FIXTURES.md section 4)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.operators.clean import CleanSpec, clean
from souk.operators.integrity import dedupe
from souk.operators.modes import dominant, latest_by
from souk.operators.ranking import SortKey, global_ntile, global_row_number, rank_buckets
from souk.operators.selection import median_values, percentile_disc


def test_grouped_rejects_account_for_three_copies(spark):
    # 3 identical rows + 1 conflicting row with the same key (D4, D5)
    rows = [("k1", "a"), ("k1", "a"), ("k1", "a"), ("k1", "b"), (None, "x")]
    df = spark.createDataFrame(rows, "id string, v string")
    spec = CleanSpec("t", key=["id"], null_reason="NULL_ID", dup_key=["id"], dup_reason="DUPLICATE_ID")
    g2 = clean(df, spec, "flag")
    cleaned = sorted((r.id, r.v, r.duplicate_flag) for r in g2.cleaned.collect())
    assert cleaned == [("k1", "a", 1), ("k1", "b", 1)]
    rej = {r.reject_reason: r.rejected_row_count for r in g2.rejects.collect()}
    assert rej == {"NULL_ID": 1, "EXACT_DUPLICATE_ROW (2 extra copies removed)": 2}
    # accounting: raw = cleaned + represented rejects
    assert 5 == len(cleaned) + sum(rej.values())
    g1 = clean(df, spec, "keep_first")
    assert [(r.id, r.v) for r in g1.cleaned.collect()] == [("k1", "a")]
    reasons = sorted(r.reject_reason for r in g1.rejects.collect())
    assert reasons == ["DUPLICATE_ID", "EXACT_DUPLICATE_ROW", "EXACT_DUPLICATE_ROW", "NULL_ID"]


def test_null_payment_type_vanishes(spark):
    # D6: a NULL type is neither rejected (NOT IN is unknown) nor cleaned (IN is unknown)
    from souk.plans.cleaning import gen2_specs

    df = spark.createDataFrame([("o1", 1, None, 1, Decimal("5.00")), ("o2", 1, "boleto", 0, Decimal("5.00"))],
                               "order_id string, payment_sequential int, payment_type string, "
                               "payment_installments int, payment_value decimal(12,2)")
    r = clean(df, gen2_specs()["payments"])
    assert r.cleaned.count() == 0
    assert [x.reject_reason for x in r.rejects.collect()] == ["INVALID_INSTALLMENTS_LESS_THAN_ONE"]


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([(" Rio ",), ("RIO\t",)], "c string")
    from souk.operators.clean import standardize

    assert [r.c for r in standardize(df, {"c": "lower"}).collect()] == ["rio", "rio\t"]


def test_dominant_tie_goes_to_first_value(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z"), (2, "y"), (2, "z")], "o int, c string")
    got = {r.o: r.c for r in dominant(df, "o", "c").collect()}
    assert got == {1: "a", 2: "z"}


def test_latest_by_breaks_timestamp_ties(spark):
    df = spark.createDataFrame([("u", 1, "o1", "x"), ("u", 1, "o2", "y"), ("v", 2, "o3", "z")],
                               "u string, ts int, oid string, city string")
    got = {r.u: r.city for r in latest_by(df, "u", "ts", ["oid"], ["city"]).collect()}
    assert got == {"u": "y", "v": "z"}


def test_dedupe_prefers_unflagged_then_smallest(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("j", 0, "q")], "k string, duplicate_flag int, v string")
    got = {r.k: r.v for r in dedupe(df, "k", ["duplicate_flag"], ["k", "v"], "duplicate_flag").collect()}
    assert got == {"k": "a", "j": "q"}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 23])
def test_ntile_matches_sql_for_small_n(spark, n):
    df = spark.createDataFrame([(i, f"c{i:03d}") for i in range(n)], "v int, id string")
    got = sorted((r.id, r.ntile) for r in global_ntile(df, 5, [SortKey("v", True)], ["id"], buckets=4).collect())
    # SQL NTILE(5) OVER (ORDER BY v DESC, id)
    order = sorted(range(n), key=lambda i: -i)
    q, rem = divmod(n, 5)
    expect, pos = {}, 0
    for tile in range(1, 6):
        size = q + (1 if tile <= rem else 0)
        for i in order[pos:pos + size]:
            expect[f"c{i:03d}"] = tile
        pos += size
    assert got == sorted(expect.items())


def test_ntile_positional_ties(spark):
    # D17: all frequencies equal -> scores follow the id tie-break, evenly sized
    df = spark.createDataFrame([(1, f"c{i:02d}") for i in range(10)], "f int, id string")
    got = [r.ntile for r in global_ntile(df, 5, [SortKey("f")], ["id"], buckets=4).orderBy("id").collect()]
    assert got == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_global_row_number_and_running_sum_across_buckets(spark):
    rows = [(i % 3, Decimal(i % 7) + Decimal("0.25"), f"id{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, v decimal(18,2), id string")
    r = rank_buckets(df, [SortKey("v", True)], ["id"], sum_col="v", buckets=12)
    assert len(r.counts) > 1  # really split into several buckets
    got = r.with_running_sum("run", "rn").orderBy("rn").collect()
    ordered = sorted(rows, key=lambda x: (-x[1], x[2]))
    acc = Decimal(0)
    for i, (row, exp) in enumerate(zip(got, ordered), start=1):
        acc += exp[1]
        assert (row.rn, row.id, row.run) == (i, exp[2], acc)


def test_percentile_disc_is_cume_dist_threshold(spark):
    vals = [5, 1, 3, 3, 9, 7, 7, 7]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    got = percentile_disc(df, "v", 0.75).collect()[0].v
    s = sorted(vals)
    # smallest v with (#rows <= v) / n >= 0.75
    expect = min(v for v in s if sum(1 for x in s if x <= v) / len(s) >= 0.75)
    assert got == expect


def test_empty_ranking(spark):
    df = spark.createDataFrame([], "v int, id string")
    assert global_row_number(df, [SortKey("v")], ["id"]).count() == 0


def test_bucket_gaps_fall_through(spark):
    # D14: 0.2550 matches no delay bucket and lands in the default
    from souk.plans.analytics import DELAY_RATIO_BUCKETS, DELAY_RATIO_DEFAULT, _rules

    df = spark.createDataFrame([(Decimal("0.2550"),), (Decimal("0.2500"),), (Decimal("0"),)],
                               "delayed_order_ratio decimal(10,4)")
    got = [r.b for r in df.select(_rules(DELAY_RATIO_BUCKETS, DELAY_RATIO_DEFAULT).alias("b")).collect()]
    assert got == [DELAY_RATIO_DEFAULT, "1–25% delayed", "0% – No delays"]


def test_csv_binds_by_position(spark, tmp_path):
    from souk.sources.csv import load_csv
    from pyspark.sql import types as T

    p = tmp_path / "in.csv"
    p.write_text('idd,txt\n1,"a ""q"" b"\n2,"line1\nline2"\n3,\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType())])
    rows = load_csv(spark, str(p), schema, free_text=True).orderBy("id").collect()
    assert [(r.id, r.text) for r in rows] == [(1, 'a "q" b'), (2, "line1\nline2"), (3, None)]


def test_hot_value_is_split_across_buckets(spark):
    # one sort value holds a third of all rows: the id tie-break still cuts it into several buckets
    n = 3000
    rows = [(1 if i % 3 == 0 else i, f"id{i:05d}") for i in range(n)]
    df = spark.createDataFrame(rows, "v int, id string")
    r = rank_buckets(df, [SortKey("v")], ["id"], buckets=12)
    hot_buckets = {row["_bucket"] for row in r.df.filter("v = 1").select("_bucket").distinct().collect()}
    assert len(hot_buckets) > 1
    assert max(r.counts) < n / 2
    got = [x.id for x in r.with_row_number("rn").orderBy("rn").collect()]
    assert got == [i for _, i in sorted(rows)]


def test_hot_key_dedupe_and_dominant(spark):
    # one order with a third of all rows
    rows = [("hot", f"c{i % 4}") for i in range(1000)] + [(f"o{i}", "c9") for i in range(2000)]
    df = spark.createDataFrame(rows, "o string, c string")
    got = {r.o: r.c for r in dominant(df, "o", "c").collect()}
    assert got["hot"] == "c0" and len(got) == 2001
    flagged = df.withColumn("duplicate_flag", F.when(F.col("o") == "hot", 1).otherwise(0))
    one = {r.o: r.c for r in dedupe(flagged, "o", ["duplicate_flag"], ["o", "c"], "duplicate_flag").collect()}
    assert one["hot"] == "c0" and len(one) == 2001


def test_hot_group_expansion_is_chunked(spark):
    # a third of the rows are identical NULL-key copies: every copy is a reject row,
    # produced chunk by chunk rather than by one task
    from souk.operators import clean as C

    rows = [(None, "same")] * 3000 + [(f"k{i}", "v") for i in range(6000)]
    df = spark.createDataFrame(rows, "id string, v string")
    spec = CleanSpec("t", key=["id"], null_reason="NULL_ID", dup_key=["id"])
    g = C.tag_groups(df, spec)
    out = C._expand(g.filter(F.col("_reason").isNotNull()), 1, chunk=500)
    assert out.count() == 3000
    per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) <= 1000 and len(per_task) >= 3
    r = clean(df, spec)
    assert r.rejects.count() == 3000 and r.cleaned.count() == 6000


@pytest.mark.parametrize("descending", [False, True])
def test_null_keys_are_ranked_over_many_buckets(spark, descending):
    rows = [(None if i % 50 == 0 else i % 97, f"id{i:05d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "v int, id string")
    got = [x.id for x in rank_buckets(df, [SortKey("v", descending)], ["id"], buckets=16).with_row_number("rn").orderBy("rn").collect()]
    nulls, rest = sorted(i for v, i in rows if v is None), [x for x in rows if x[0] is not None]
    rest = [i for _, i in sorted(rest, key=lambda x: (-x[0] if descending else x[0], x[1]))]
    assert got == (rest + nulls if descending else nulls + rest)


def test_percentile_and_median_of_a_hot_value(spark):
    values = [7] * 5000 + list(range(5000)) + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v int")
    s = sorted(v for v in values if v is not None)
    assert percentile_disc(df, "v", 0.75).first().v == s[-(-len(s) * 3 // 4) - 1]
    assert sorted(median_values(df, "v")) == [s[len(s) // 2 - 1], s[len(s) // 2]]
    assert median_values(df.filter("v < 0"), "v") == [] and percentile_disc(df.filter("v < 0"), "v", 0.75).count() == 0


def test_csv_stops_at_a_malformed_number_and_splits_files(spark, tmp_path):
    from pyspark.sql import types as T
    from souk.sources.csv import load_csv

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    (tmp_path / "bad.csv").write_text("id,n\n1,2\n3,x\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        load_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
    (tmp_path / "big.csv").write_text("id,n\n" + "".join(f"{i},{i}\n" for i in range(200_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = load_csv(spark, str(tmp_path / "big.csv"), schema)
        assert df.rdd.getNumPartitions() > 3 and df.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from souk.session import checkpoint_dir

    none = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getConf=lambda: none, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=none))


def test_ri_check_counts_a_hot_key_first(spark):
    from souk.operators.integrity import ri_check

    child = spark.createDataFrame([("hot",)] * 900 + [(f"k{i}",) for i in range(90)] + [(None,)] * 10, "k string")
    parent = spark.createDataFrame([("hot",), ("hot",), ("k1",)], "k string")
    assert tuple(ri_check("x", child, "k", parent, "k").first())[:3] == ("x", 1000, 99)
