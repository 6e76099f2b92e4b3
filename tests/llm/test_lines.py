import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from souk.llm import lines
from souk.llm.queries import op11_line_dedup

GAP = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(GAP))


def brute(rows):
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                holders[key_of(x)].add(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        gone = [i is not None and len(key_of(x)) >= 20 and len(holders[key_of(x)]) >= 3 and i != max(holders[key_of(x)]) for x in parts]
        kept = "\n".join(x for x, g in zip(parts, gone) if not g)
        out.append((i, len(parts), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_like_sql(spark, tables, rows_like):
    got = rows_like(op11_line_dedup(spark, "/root/testdata/sf0.001"), tables, lines.LINES_SQL)
    assert sum(r[2] for r in got) > 0


def corpus(seed, n=150):
    r = random.Random(seed)
    common = [f"a line that several documents hold, {k}" for k in range(12)] + ["ÄÖÜ äöü ßßß ÀÉÎ ñandú ok", "exactly twenty chars", "only nineteen chars"]
    rows = []
    for i in range(n):
        parts = [f"{'  ' * r.randrange(2)}{r.choice(common)}{r.choice(['', ' ', chr(9), chr(13)])}" for _ in range(r.randrange(5))]
        parts += [x.upper() for x in r.sample(common, r.randrange(2))]
        parts += [f"own line of document {i} number {k}" for k in range(r.randrange(4))] + [""] * r.randrange(2)
        r.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    return rows


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_like_brute_force(spark, parts):
    rows = corpus(parts)
    rows += [(1000 + k, "one very common line of the corpus\n" * (1 + k % 5)) for k in range(300)]  # a third of all lines
    rows += [(7, None), (8, ""), (None, "one very common line of the corpus\nx"), (None, None), rows[3], rows[3], (3, "another text of three\none very common line of the corpus")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((tuple(x) for x in lines.line_digests(df).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)


@pytest.mark.parametrize("seed", range(40))
def test_stream_at_any_cut(seed):
    """Ranges and batches cut anywhere: what the stream drops, with the pieces' counts, is what a look at all rows drops."""
    r = random.Random(seed)
    rows = sorted(((r.randrange(6), 0, r.randrange(8) if seed % 2 else r.randrange(3), 0, k) for k in range(60)), key=lambda x: (x[0], x[1], -x[2], x[4]))
    ranges = sorted(r.sample(range(1, 60), r.randrange(6)))
    dropped, undecided, pieces = [], [], []
    for a, b in zip([0, *ranges], [*ranges, 60]):
        cuts = sorted(r.sample(range(a, b), min(b - a, r.randrange(5))))
        batches = [pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows[p:q]], pa.int32() if c == 4 else pa.int64()) for c in range(5)], names=["h1", "h2", "doc_id", "row", "pos"]) for p, q in zip([a, *cuts], [*cuts, b])]
        for out in lines.stream(iter(batches), 3):
            for x in out.to_pylist():
                (dropped, undecided, pieces)[x["kind"]].append(x)
    docs = defaultdict(set)
    for x in rows:
        docs[x[0]].add(x[2])
    of_key = defaultdict(list)
    for x in pieces:
        of_key[x["h1"]].append((x["doc_id"], x["least"], x["n_docs"]))
    got = {x["pos"] for x in dropped}
    for x in undecided:
        p = sorted(of_key[x["h1"]], reverse=True)
        n = sum(y[2] for y in p) - sum(y[1] == z[0] for y, z in zip(p, p[1:]))
        if n >= 3 and x["doc_id"] < p[0][0]:
            got.add(x["pos"])
    assert got == {x[4] for x in rows if len(docs[x[0]]) >= 3 and x[2] != max(docs[x[0]])}
    assert len(pieces) <= 2 * (len(ranges) + 1)


def test_texts_keep_other_columns(spark):
    line = "a line of more than twenty characters"
    rows = [(i, f"{line}\nown {i}", f"k{i}", i, {"a": i}) for i in range(4)] + [(9, None, "k9", 9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep string, row long, given map<string,int>")
    got = sorted(tuple(x) for x in lines.without_repeated_lines(df).collect())
    assert got == [(i, f"own {i}" if i < 3 else f"{line}\nown 3", f"k{i}", i, {"a": i}) for i in range(4)] + [rows[4]]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.line_digests(empty).count() == 0 and lines.keep_bitmaps(empty).count() == 0


def test_long_text_and_bitmap(spark):
    line = "the same line again and again and again"
    rows = [(1, f"{line}\nx\n" * 50_000), (2, line), (3, line), (4, "y" * 1_000_000)]
    got = {x.doc_id: x for x in lines.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(got) == [1, 2] and len(got[1].keep) < 1000
    keep = lines.unpack(got[1].keep, 100_001)
    assert not keep[:100_000:2].any() and keep[1::2].all() and keep[100_000]
    assert (lines.unpack(lines.pack(np.array([3])), 6) == [True, True, True, False, True, True]).all()
