import numpy as np
import pytest

from souk.llm import negatives
from souk.llm.queries import op13_hard_negatives


def brute(rows, anchors, s=negatives.Settings()):
    fine = [(i, c, tuple(map(float, v))) for i, c, v in rows if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fine = sorted(set(fine))
    dim = max([len(v) for *_, v in fine], default=0)
    pad = {v: np.array(v + (0.0,) * (dim - len(v))) for *_, v in fine}
    out, seen = [], set()
    for i, c, v in fine:
        if i in seen or not anchors(i):
            continue
        seen.add(i)
        scored = [(-float(pad[v] @ pad[w]), j, d) for j, d, w in fine]
        positives = sorted((x, j) for x, j, d in scored if d == c and j != i)[: s.positives]
        for x, p in positives:
            hard = sorted((y, j) for y, j, d in scored if d != c and -x * s.least <= -y * 100 <= -x * s.greatest)[: s.negatives]
            out += [(i, p, k + 1, j, -x, -y) for k, (y, j) in enumerate(hard)]
    return sorted(out)


def vectors(seed, n, dim=6, topics=5):
    r = np.random.default_rng(seed)
    centres = r.integers(-40, 40, (topics, dim))
    return [(int(i), int(r.integers(4)), [float(x) for x in centres[r.integers(topics)] + r.integers(-6, 7, dim)]) for i in range(n)]


def same(spark, rows, settings=negatives.Settings(), every=10, schema="vec_id long, label int, embedding array<double>"):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = sorted(tuple(x) for x in negatives.hard_negatives(df, f"vec_id % {every} = 0", settings).collect())
    assert got == brute(rows, lambda i: i % every == 0, settings)
    return got


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    rows = vectors(seed, 700)
    small = negatives.Settings(leaf=0.2, degree=4, sample=200, block=50, slice=7)  # deep tree, many blocks and slices
    assert len(same(spark, rows, small)) > 500
    same(spark, rows[:60], negatives.Settings(leaf=0.2, degree=4, least=-20, greatest=95, positives=2, negatives=9))


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = vectors(9, 400) + [(1000 + i, i % 2, [30.0, -20.0, 10.0, 5.0, 0.0, 1.0]) for i in range(200)]
    same(spark, rows, negatives.Settings(leaf=0.3, degree=4, block=32, slice=16))


def test_edge_rows(spark):
    rows = vectors(4, 80) + [(100, None, [1.0] * 6), (110, 1, None), (120, 1, [1.0, None] * 3), (130, 1, [float("nan")] * 6), (None, 1, [1.0] * 6), (140, 1, [float("inf")] * 6)]
    rows += [(150, 1, [5.0, 6.0]), (151, 2, []), (160, 3, [9.0] * 6), (160, 3, [9.0] * 6), (160, 2, [8.0] * 6), (160, 3, [-0.0] * 6), (170, 99, [1.0] * 6)]
    got = same(spark, rows)
    assert not {x[0] for x in got} & {100, 110, 120, 130, 140, 170}
    df = spark.createDataFrame([(r[0], str(r[1]), r[2], 1.0) for r in rows if r[1] is not None], "vec_id long, label string, embedding array<float>, score double")
    assert negatives.hard_negatives(df, "vec_id % 10 = 0").count() == len(got)
    assert negatives.hard_negatives(df.limit(0), "vec_id % 10 = 0").count() == 0


def test_siblings_are_left_out_but_no_row_is(spark):
    """Leaves that a window leaves out hold no row of it; in separate topics most are left out."""
    r = np.random.default_rng(2)
    x = np.vstack([100 * np.eye(8)[k] + r.standard_normal((100, 8)) for k in range(8)])
    nodes, leaves = negatives.grow(x[::3], 2, s := negatives.Settings(degree=8))
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, e array<double>")
    located = negatives._located(df, nodes, "int")
    negatives._measure(located, nodes, s)
    leaf = {z.vec_id: z.leaf for z in located.collect()}
    visited = 0
    for k in range(0, 800, 40):
        score = x @ x[k]
        for least, greatest in ((9000, 1e9), (-50, 50), (score.min(), score.min() + 5)):
            seen = {a for a, _ in negatives.remaining(nodes, x[k : k + 1], np.array([least]), np.array([greatest]))}
            assert {leaf[i] for i in np.flatnonzero((score >= least) & (score <= greatest))} <= seen
            visited += len(seen) if least == 9000 else 0
    assert visited < 0.3 * leaves * 20


def test_like_sql(spark, tables, rows_like):
    got = rows_like(op13_hard_negatives(spark, "/root/testdata/sf0.001"), tables, negatives.NEGATIVES_SQL)
    assert len(got) > 20
