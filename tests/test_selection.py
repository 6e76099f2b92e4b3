"""Positions, percentiles and tiles from counts of values, against sorted lists."""

import random
from decimal import Decimal

import pytest

from souk.operators import selection as S
from souk.operators.ranking import SortKey
from souk.operators.selection import median_values, percentile_disc


def ntile(ordered, k):
    q, r = divmod(len(ordered), k)
    out, at = {}, 0
    for t in range(1, k + 1):
        size = q + (t <= r)
        out |= {x: t for x in ordered[at : at + size]}
        at += size
    return out


def order(rows, col, descending):
    key = lambda x: ((x[col] is None) == descending, 0 if x[col] is None else -x[col] if descending else x[col], x[0])
    return [x[0] for x in sorted(rows, key=key)]


def made(seed, n):
    r = random.Random(seed)
    return [(f"c{i:05d}", 7 if r.random() < 0.4 else r.randrange(50), Decimal(r.randrange(10**7)) / 100 if r.random() < 0.9 else None,
             r.choice([None, 1, 1, 1]), -(2**62) if r.random() < 0.1 else r.randrange(-(2**61), 2**61)) for i in r.sample(range(n), n)]


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6, 23, 1500])
def test_tiles_like_sql(spark, n):
    rows = made(n, n)
    df = spark.createDataFrame(rows, "id string, d int, m decimal(18,2), f int, big bigint").repartition(4)
    keys = {"d": SortKey("d", True), "m": SortKey("m"), "m2": SortKey("m", True), "f": SortKey("f"), "big": SortKey("big")}
    t = S.tiles(df, keys, "id", 5)
    got = {r[0]: tuple(r)[1:] for r in df.select("id", *[c.alias(f"t_{name}") for name, c in t.items()]).collect()}
    cols = {"d": 1, "m": 2, "m2": 2, "f": 3, "big": 4}
    want = [ntile(order(rows, cols[name], key.descending), 5) for name, key in keys.items()]
    assert got == {x[0]: tuple(w[x[0]] for w in want) for x in rows}


def test_hot_ties_are_ranked_in_ranges(spark):
    """All customers hold one value: the ends fall inside it and only ids decide."""
    rows = [(f"c{i:05d}", 1) for i in range(4003)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "id string, f int").repartition(6)
    got = {r.id: r.t for r in df.select("id", S.tiles(df, {"f": SortKey("f")}, "id", 5)["f"].alias("t")).collect()}
    assert got == ntile([r[0] for r in rows], 5)


def test_assigning_tiles_shuffles_nothing(spark):
    df = spark.createDataFrame(made(3, 500), "id string, d int, m decimal(18,2), f int, big bigint")
    plan = df.select("id", S.tiles(df, {"d": SortKey("d"), "m": SortKey("m")}, "id", 5)["m"].alias("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_many_cells_and_positions(spark, monkeypatch):
    monkeypatch.setattr(S, "CELLS", 7)  # many passes
    r = random.Random(5)
    values = [r.randrange(-300, 300) for _ in range(900)] + [5] * 300
    df = spark.createDataFrame([(v,) for v in values], "v int")
    ordered = sorted(values)
    at = [1, 2, 400, 700, 1199, 1200]
    places = S.values_at(df, {"v": SortKey("v")}, {"v": [0, *at, 1201]})["v"]
    assert sorted(places) == at
    for p in at:
        v = ordered[p - 1]
        assert places[p] == S.Place(v, ordered.index(v), ordered.count(v))


def test_median_and_percentile(spark):
    for values in ([5, 1, 3, 3, 9, 7, 7, 7], [Decimal("1.25"), None, Decimal("-3.10")], [None, None], []):
        kind = "decimal(18,2)" if any(isinstance(v, Decimal) for v in values) else "int"
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        s = sorted(v for v in values if v is not None)
        middle = sorted({(len(s) - 1) // 2, len(s) // 2}) if s else []
        assert median_values(df, "v") == [s[i] for i in middle]
        got = [r.v for r in percentile_disc(df, "v", 0.75).collect()]
        assert got == ([s[-(-len(s) * 3 // 4) - 1]] if s else [])


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError, match="float"):
        S.whole_number(spark.createDataFrame([(1.0,)], "v float"), "v")
