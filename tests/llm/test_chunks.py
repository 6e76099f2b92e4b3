import random

from souk.llm import chunks


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyzéß", k=r.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(60) for _ in range(40)]
    line = text(12)
    rows, holders = [], {}
    for i in range(400):
        t = text(r.randint(0, 200)) + "\n" + line + "\n" + text(r.randint(0, 200))
        if i % 4 == 0:
            k = (i // 4) % 40
            t = text(r.randint(0, 30)) + " " + passages[k] + " " + t
            holders.setdefault(k, []).append(i)
        rows.append((i, t))
    rows += [(1000, None), (1001, ""), (1002, "q " * 30_000), (1003, rows[4][1]), (1003, rows[4][1]), (None, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = chunks.repeated_passages(docs).collect()
    texts = dict(rows)
    assert {x.doc_id for x in got} == {i for h in holders.values() if len(h) > 1 for i in h} | {4, 1003}
    inside = [texts[x.doc_id][x.start : x.end] in texts[x.first_doc_id] for x in got]
    assert sum(inside) >= 0.9 * len(got)  # the others stand beside the common line, which begins in another document
    assert {(x.first_doc_id, x.is_first) for x in got if x.doc_id == 1003} == {(4, False)}
    cut = {x.doc_id: x.text for x in chunks.without_repeats(docs).collect()}
    assert cut[1] == texts[1] and len(cut[1003]) < 40 and cut[1000] is None
    assert chunks.repeated_passages(docs.limit(0)).count() == 0


def test_chunks_do_not_shift():
    r = random.Random(6)
    t = "".join(r.choices("abcdefgh ", k=4000))
    s = chunks.Settings()
    a, b = set(chunks.units(t, s)[0].tolist()), set(chunks.units("inserted " + t, s)[0].tolist())
    assert len(a - b) <= 3
    data = chunks.np.frombuffer(b"a" * 200_000, chunks.np.uint8)
    assert chunks.np.diff(chunks.cuts(data, 32)).max() <= chunks.LONGEST


def words(r, n):
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 8))) for _ in range(n))


def test_passages_just_over_the_limit_are_found_exactly(spark):
    r = random.Random(11)
    rows, planted = [], {}
    for k in range(150):
        passage = words(r, 51)
        for copy in range(2):
            before, after = (words(r, 80) + " " if k % 3 else ""), (" " + words(r, 80) if k % 3 != 2 else "")
            rows.append((2 * k + copy, before + passage + after))
            planted[2 * k + copy] = passage
    rows += [(1000 + k, words(r, 80) + " " + x + " " + words(r, 80)) for k, x in enumerate([words(r, 49)] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts, got = dict(rows), chunks.repeated_passages(docs).collect()
    assert all(texts[x.doc_id][x.start : x.end] == planted[x.doc_id] and x.n_words == 51 and x.first_doc_id == x.doc_id // 2 * 2 for x in got)
    # a candidate needs three cuts in common, which a passage of this length lacks once in some 170 cases
    assert len(got) == len({x.doc_id for x in got}) >= 2 * 147


def test_first_holder_of_edited_copies_and_of_copies_beside_originals(spark):
    r = random.Random(12)
    parts = [words(r, 120) for _ in range(3)]
    one = " ".join(parts)
    five = " ".join([parts[0], words(r, 20), parts[1], words(r, 20), parts[2]])
    original = words(r, 100)
    mixed = parts[1] + " " + original
    rows = [(1, one), (5, five), (7, five), (8, mixed), (9, words(r, 30) + " " + original)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts, got = dict(rows), chunks.repeated_passages(docs).collect()
    assert all(texts[x.doc_id][x.start : x.end] in texts[x.first_doc_id] for x in got)
    spans = lambda i, first: sorted(texts[i][x.start : x.end] for x in got if x.doc_id == i and x.first_doc_id == first)
    assert spans(5, 1) == sorted(parts) and spans(7, 5) == [five] and spans(9, 8) == [original] and spans(8, 1) == [parts[1]]
    cut = {x.doc_id: x.text for x in chunks.without_repeats(docs).collect()}
    assert cut[1] == one and cut[7] == "" and len(cut[5].split()) == 40 and cut[8].strip() == original and len(cut[9].split()) == 30
