import hashlib
import random
import zlib

import pytest

from souk.llm import runs
from souk.llm.queries import op12_periodic_runs


def brute(t, least=24, periods=3):
    """All maximal stretches per period, those of a multiple of a smaller period of the same stretch left out."""
    found, n = [], len(t)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if t[i] != t[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and t[j] == t[j + q]:
                j += 1
            if j + q - i >= max(least, periods * q):
                found.append((i, j + q - i, q))
            i = j
    smallest = lambda s, length: next(q for q in range(1, length + 1) if all(t[k] == t[k + q] for k in range(s, s + length - q)))
    return sorted((x for x in found if smallest(x[0], x[1]) == x[2]), key=lambda x: (x[0], x[2]))


def texts(r):
    kind, t = r.randrange(4), []
    for _ in range(r.randrange(1, 6)):
        if kind == 0:
            t += [r.choice("ab") for _ in range(r.randrange(60))]
        unit = [r.choice("abcdefgh"[: r.randrange(1, 9)]) for _ in range(r.randrange(1, 25))]
        t += unit * r.randrange(1, 8) + unit[: r.randrange(len(unit))]
        if kind == 1:
            t = (t * 4)[: r.randrange(200, 300)]
        if kind == 2:
            t += [str(r.random()) for _ in range(r.randrange(20))]
    return t[:400]


@pytest.mark.parametrize("seed", range(150))
def test_like_brute_force(seed):
    t = texts(random.Random(seed))
    assert runs.periodic_runs(t) == brute(t)
    low = runs.Settings(least_words=6, least_periods=2)  # no grams: the automaton runs on the whole text
    assert runs.periodic_runs(t, low) == brute(t, 6, 2)
    four = runs.Settings(least_words=10, least_periods=4)
    assert runs.periodic_runs(t, four) == brute(t, 10, 4)


def test_fibonacci_words_and_one_word():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    assert runs.periodic_runs(list(b), runs.Settings(least_words=4, least_periods=2)) == brute(list(b), 4, 2)
    assert runs.periodic_runs(["x"] * 50_000) == [(0, 50_000, 1)]
    assert runs.periodic_runs([]) == [] and runs.periodic_runs(["x"] * 23) == []


def expected(i, text):
    words = (text or "").encode().split()
    n = len(words)
    if i is not None and n:
        h = zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = brute(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = next((x for x in found if all(x[1] * y[2] >= y[1] * x[2] for y in found)), (None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digest = lambda b: hashlib.sha256(b).hexdigest()
    all_runs = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (i, len(found), *best, milli, digest(all_runs.encode()), digest(b" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_query_like_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = {d.doc_id: expected(d.doc_id, d.text) for d in docs if len(d.text or "") < 6000}
    got = {x.doc_id: tuple(x) for x in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == {d.doc_id for d in docs}
    assert {i: got[i] for i in short} == short
    assert sum(x[1] > 0 for x in got.values()) > 10


def test_edge_rows(spark):
    again = "a b c d e f g h i j " * 3
    rows = [(None, again, 1), (None, None, 2), (1, None, 3), (2, "", 4), (3, " \t\n ", 5), (4, again, 6), (4, again, 6), (5, again.replace(" ", "\x0b\r"), 7), (6, "ä b " * 30, 8)]
    rows += [(-k, "u v w x y z " * 9 + "end", k) for k in range(10, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted((tuple(x) for x in runs.run_digests(runs.with_planted_runs(df)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t, _ in rows), key=str)
    assert runs.run_digests(runs.with_planted_runs(df.limit(0))).count() == 0


def test_collapsed_text(spark):
    df = spark.createDataFrame([(1, "start " + "one two three four five six seven eight " * 4 + "end")], "doc_id long, text string")
    got = runs.document_runs(df).first()
    assert got.collapsed == "start one two three four five six seven eight end"
    assert [tuple(x) for x in got.runs] == [(1, 32, 8)] and got.n_words == 34
