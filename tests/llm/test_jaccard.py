import glob
import random

import pytest
from souk.llm import jaccard
from souk.llm.common import Stage, ascii_words


def brute(rows):
    sets = {}
    for i, text in rows:
        w = ascii_words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                comp[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=220):
    """Copies, near copies at the threshold, a very common line, documents mostly of common passages, short ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 6)))
    passage = [word() for _ in range(60)]
    line = [word() for _ in range(12)]
    base = [word() for _ in range(90)]
    out = []
    for i in range(n):
        kind = i % 8
        if kind == 0:
            w = [word() for _ in range(r.randint(0, 12))]
        elif kind in (1, 2):  # one large group of near copies
            w = base[:]
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = word()
            w += [word() for _ in range(r.randint(0, 4))]
        elif kind == 3:  # mostly a common passage
            w = passage + [word() for _ in range(r.randint(0, 25))]
        elif kind == 4 and out:  # a near copy of any earlier one, around the threshold
            w = r.choice(out)[1].split()
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                if w:
                    w[r.randrange(len(w))] = word()
        elif kind == 5:
            w = line + [word() for _ in range(r.randint(10, 80))]
        elif kind == 6 and out:
            w = r.choice(out)[1].upper().split()
        else:
            w = line + [word() for _ in range(r.randint(0, 9))]
        out.append((i * 3 + 5, r.choice([" ", "\n", "\t "]).join(w)))
    return out


@pytest.mark.parametrize("seed,small", [(1, 32), (2, 3)])
def test_like_brute_force(spark, seed, small):
    rows = corpus(seed)
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), small=small).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (4, "A b", "x"), (5, "a  B", "x"), (6, "a b", "y"), (None, "a b", "y"), (7, "w " * 30_000, "y"), (8, "w " * 29_999, "z"), (6, "a b", "y"), (9, "a b c d", "y"), (10, "Ä b", "x"), (11, "ä b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted((tuple(x) for x in jaccard.similar_documents(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 4), (6, 1, 4), (None, 1, None), (7, 1, 7), (8, 1, 7), (9, 1, 9), (10, 1, 10), (11, 1, 11)], key=str)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(x.doc_id) for x in kept.collect())) == sorted(map(str, [1, 2, 3, 4, 7, 9, 10, 11, None]))
    assert jaccard.similar_documents(docs.limit(0)).count() == 0


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark):
    a, b = [f"w{k}" for k in range(60)], [f"v{k}" for k in range(60)]
    near = " ".join([*a[:-1], "x"])
    rows = [(1, " ".join(a), {"k": 1}), (5, near, {"k": 2}), (5, " ".join(b), {"k": 3}), (9, " ".join(b), {"k": 4}), (None, near, None), (7, "", None), (7, None, None)]
    rows += [(3, "a text that stands twice under one id", {"k": k}) for k in (6, 5, 7)] + [(4, "A text that stands twice under one id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component map<string,int>").repartition(3)
    got = sorted(((x.doc_id, x.text, x.component) for x in jaccard.keep_one_of_each(docs).collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[4], rows[5], rows[6], (3, rows[7][1], {"k": 5})], key=str)
    groups = {(x.doc_id, x.n_shingles): x.component_id for x in jaccard.similar_documents(docs).collect()}
    assert groups[5, 56] in (1, 5) and groups[9, 56] == 5 and groups[4, 4] == 3


def many(r, sizes):
    """Groups of near copies: every member has some words of its group's text changed."""
    out = []
    for g, size in enumerate(sizes):
        base = [f"g{g}w{k}" for k in range(r.randint(70, 110))]
        for _ in range(size):
            w = base[:]
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
            out.append((len(out), " ".join(w)))
    return out


def test_pairs_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    """Rows that the joins of candidates make, at two sizes of one group of near copies."""
    made = {}
    near, measured = jaccard._near, jaccard._distances
    monkeypatch.setattr(jaccard, "_near", lambda pairs, sets, stage: (made.__setitem__(size, made.get(size, 0) + pairs.count()), near(pairs, sets, stage))[1])
    monkeypatch.setattr(jaccard, "_distances", lambda pairs, sets, stage: (made.__setitem__(size, made.get(size, 0) + pairs.count()), measured(pairs, sets, stage))[1])
    for size in (80, 320):
        rows = many(random.Random(size), [size, 5, 2, 40])
        got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), small=8).collect()
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(rows)
    assert made[320] < 7 * made[80], made


def test_documents_that_share_a_line_do_not_meet(spark, monkeypatch):
    """A few segments in common cannot be a link: no texts are read again for such pairs."""
    r, met, near = random.Random(5), [], jaccard._near
    monkeypatch.setattr(jaccard, "_near", lambda pairs, sets, stage: (met.extend(pairs.collect()), near(pairs, sets, stage))[1])
    word = lambda: f"w{r.randrange(10**6)}"
    rows = []
    for _ in range(12):
        line = [word() for _ in range(15)]
        rows += [(len(rows) + k, " ".join([*line, *[word() for _ in range(120)]])) for k in range(6)]
    rows.append((len(rows), rows[0][1] + " " + word()))
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(rows)
    assert len(met) == 1, met


def test_near_copies_of_a_task_share_rows(spark, monkeypatch):
    """The second step makes rows for what differs in a group, not one for each key of each member."""
    made, second = [], jaccard._second
    monkeypatch.setattr(jaccard, "_second", lambda sets: (made.append((sets.count(), second(sets).count())), second(sets))[1])
    r = random.Random(3)
    base = [f"b{k}" for k in range(100)]
    rows = [(i, " ".join([*base[:60], *[f"x{r.randrange(10**6)}" for _ in range(4)], *base[60:]])) for i in range(120)]
    rows += [(1000 + i, " ".join([*base[:70], *[f"y{r.randrange(10**6)}" for _ in range(30)]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = jaccard.similar_documents(docs, small=8).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(rows)
    assert made and all(rows < 100 * sets for sets, rows in made), made


def test_large_sets_are_shuffled(spark, monkeypatch):
    sets = spark.createDataFrame([(k, 5, bytes(100), bytes(500)) for k in range(100)], "set long, n long, bits binary, s binary")
    plan = lambda: jaccard._light(sets, "bits", "s")._jdf.queryExecution().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr(jaccard, "BROADCAST_SETS", 60_000)  # 600 bytes and two longs a row
    assert "broadcast" not in plan()
    rows = corpus(3)
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), small=3).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(rows)


def test_keys_are_dealt_by_their_volume(spark):
    """A small table makes few files, however many shuffle partitions there are."""
    rows, stage, before = corpus(4), Stage(spark, "test"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), stage, small=4).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(rows)
    files = {name: len(glob.glob(f"{stage.root.removeprefix('file://')}/*-{name}/part-*")) for name in ("first", "second")}
    assert all(0 < n <= 4 for n in files.values()), files
