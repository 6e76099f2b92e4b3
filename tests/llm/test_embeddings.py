import os

import numpy as np

from souk.llm import embeddings
from souk.llm.common import Stage


def brute(rows):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ids = [i for i, _ in fine]
    u = np.array([v / np.linalg.norm(v) for _, v in fine])
    near = u @ u.T >= 0.9
    comp = list(ids)
    changed = True
    while changed:
        changed = False
        for k in range(len(ids)):
            low = min(comp[j] for j in np.flatnonzero(near[k]))
            if low < comp[k]:
                comp[k], changed = low, True
    out = {i: (0, i, True) for i, _ in rows if i is not None}
    out |= {i: (int(near[k].sum()) - 1, comp[k], comp[k] == i) for k, i in enumerate(ids)}
    return out


def test_like_brute_force(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal((60, 16))
    rows = [(int(i), v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 20] + 0.1 * r.standard_normal(16)).tolist()) for i in range(60)]  # cosine near 0.99
    rows += [(300 + i, (base[0] + 0.15 * r.standard_normal(16)).tolist()) for i in range(150)]  # one large group
    rows += [(500 + i, base[30].tolist()) for i in range(40)]  # copies
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, [1.0]), (905, [float("inf")] * 16), (906, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embeddings.near_vectors(df, embeddings.Settings(block=128)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert {i: got[i] for i in got if got[i] != want[i]} == {}


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], "x"), (1, [1.0, 0.0], "y"), (2, [2.0, 0.0], "y")], "vec_id long, embedding array<float>, component_id string")
    got = sorted((tuple(x) for x in embeddings.near_vectors(df).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)], key=str)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_recall_in_a_hot_topic_and_at_size(spark):
    """Pairs at cosine 0.901 to 0.93, a third of them inside a topic of mutual cosine 0.8, among far more rows than a run holds."""
    r = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n, dim, pairs = 12_000, 64, 600
    base = unit(r.standard_normal((n, dim)))
    topic = unit(r.standard_normal(dim))
    hot = n // 3
    side = unit(base[:hot] - (base[:hot] @ topic)[:, None] * topic)
    base[:hot] = np.sqrt(0.8) * topic + np.sqrt(0.2) * side  # mutual cosine 0.8
    at = r.choice(n, pairs, replace=False)
    cos = r.uniform(0.901, 0.93, pairs)[:, None]
    off = r.standard_normal((pairs, dim))
    off = unit(off - (off * base[at]).sum(axis=1, keepdims=True) * base[at])
    x = np.vstack([base, cos * base[at] + np.sqrt(1 - cos**2) * off])
    near = x @ x.T >= 0.9
    want = near.sum(axis=1) - 1
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(8)
    got = {v.vec_id: v.n_links for v in embeddings.near_vectors(df, embeddings.Settings(block=512)).collect()}
    assert embeddings._bits(df.selectExpr("vec_id as node", "embedding as e"), len(x), embeddings.Settings(block=512)) > 0
    assert want.sum() >= 2 * pairs
    assert sum(got.values()) >= 0.999 * want.sum()


def test_each_length_is_compared_among_its_own(spark):
    r = np.random.default_rng(9)
    rows = [(i, v.tolist()) for i, v in enumerate(r.standard_normal((300, 16)))]
    base = r.standard_normal((50, 24))
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(base)] + [(2000 + i, (v + 0.01).tolist()) for i, v in enumerate(base)]
    rows += [(3000, [1.0, 2.0]), (3001, [1.0, 2.0]), (3002, [2.0, 4.0]), (3003, [2.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {x.vec_id: (x.n_links, x.component_id) for x in embeddings.near_vectors(df, embeddings.Settings(block=64)).collect()}
    assert all(got[1000 + i] == (1, 1000 + i) == got[2000 + i] for i in range(50))
    assert [got[i] for i in range(3000, 3004)] == [(2, 3000)] * 3 + [(0, 3003)]


def test_a_window_reaches_beyond_its_run(spark):
    """Rows of one pass in sorted order: neighbours within ``window`` meet whatever their signs, farther ones only inside a run."""
    rows = [(0, 2, run, node, np.array([1.0, node * 1e-3]).tobytes()) for node, run in enumerate([0, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6])]
    df = spark.createDataFrame([(*r[:3], r[3], bytearray(r[4])) for r in rows], "pass int, dim int, run long, node long, x binary").coalesce(1).sortWithinPartitions("node")
    found = {frozenset(x) for x in embeddings._window_links(df, embeddings.Settings(window=2)).collect()}
    comp = list(range(15))
    for _ in range(15):
        for a, b in map(tuple, found):
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert comp == [0] * 15
    near = {frozenset(x) for x in embeddings._window_links(df.filter("node in (0, 1, 13, 14)"), embeddings.Settings(window=1)).collect()}
    assert near == {frozenset((0, 1)), frozenset((1, 13)), frozenset((13, 14))}


def test_small_tables_take_the_same_path(spark):
    df = spark.createDataFrame([(i, [float(i % 5), 1.0, 2.0]) for i in range(30)], "vec_id long, embedding array<double>")
    assert embeddings._bits(df.selectExpr("vec_id as node", "embedding as e"), 30, embeddings.Settings()) >= 1


def test_links_of_the_passes_are_written_once(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + 0.05 * r.standard_normal(16)).tolist()) for i in range(160)]
    stage = Stage(spark, "test")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), stage=stage).collect()}
    assert got == brute(rows)
    assert sum(x.endswith("-links") for x in os.listdir(stage.root.removeprefix("file://"))) == 1
