"""The operators in built-in functions: personal data, mixing, quality, chat."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from souk.llm import chat, mixing, pii, quality, queries

SMALL = "/root/testdata/sf0.001"
EXTRA = [
    (10**6, None), (10**6 + 1, ""), (10**6 + 1, ""), (None, "x a@b.c"),
    (10**6 + 2, "é\U0001f600a.b@c.d_e@f.g x@y @z.z 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 +1 (650) 253-0000 1.2.3.400 +12 000255.01.1.1"),
    (10**6 + 3, "a@b" * 3000 + "1 " * 9000 + "." * 9000 + "x" * 9000 + "#*|\n" * 3000),
    (10**6 + 4, " \n\t\n a b c a b c a b c\r\na b c\n\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(EXTRA, "doc_id long, text string"))


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    t, digits = text or "", lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]


def test_base_spans(docs):
    got = pii.personal_data_spans(docs.withColumn("spans", F.lit("clash"))).collect()
    want = collections.Counter()
    for x in docs.collect():
        b = base(x.text)
        n = collections.Counter(k for k, *_ in b)
        want[(x.doc_id, *(n[k] for k in pii.KINDS), hashlib.sha256(",".join(f"{k}:{a}:{e}" for k, a, e in b).encode()).hexdigest())] += 1
    assert collections.Counter(tuple(x)[:6] for x in got) == want


def test_terms_that_disclose_an_entity(spark):
    rows = [(i, f"common words here\nzorblax wrote to joe@site.org about gardens") for i in range(4)]
    rows += [(10 + i, "gardens are common\nwords about words") for i in range(40)] + [(60, "zorblax alone")] * 0 + [(70, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.spans for x in pii.personal_data_spans(docs).collect()}
    text = rows[0][1]
    at = text.index("zorblax")
    assert f"removed:{at}:{at + 7}" in got[0].split(",") and "email:" in got[0]
    gardens = text.index("gardens")
    assert f"removed:{gardens}:{gardens + 7}" not in got[0]  # frequent elsewhere
    assert all(got[i] == "" for i in got if i >= 10)
    clean = {x.doc_id: x.text for x in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in clean[0] and "zorblax" not in clean[0] and clean[0].startswith("common words here\n")
    assert all(clean[i] == t for i, t in rows if i >= 10)
    assert pii.personal_data_spans(docs.limit(0)).count() == 0


def test_mixture_like_sql(spark, tables, rows_like):
    got = rows_like(queries.op5_mixture(spark, SMALL), tables, mixing.MIXTURE_SQL)
    assert len(got) > 100


def test_mixture_rates_and_edges(spark):
    rows = [(i, "a" if i % 3 else "b", "t") for i in range(3000)] + [(None, None, None), (5, "rare", ""), (5, "rare", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    n = collections.Counter(x.source for x in mixing.mix(docs, mixing.Settings(weights={"a": 1.0, "b": 3.0})).collect())
    assert n["a"] + n["b"] == sum(n.values()) and abs(n["b"] / n["a"] - 3) < 0.5 and abs(sum(n.values()) - 3003) < 250
    many = mixing.replicate(docs.filter("source = 'rare'"), mixing.Settings(epochs=200.0)).groupBy("doc_id").count().first()
    assert 300 < many["count"] < 500  # two rows, each near 200: a mean beyond one chunk
    out = mixing.mix(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0


def counts(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(tri)
    covered = {j for i, g in enumerate(tri) if often[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_rules(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = quality.quality_verdicts(docs, labels).collect()
    want = collections.Counter()
    for x in docs.collect():
        c = counts(x.text)
        want[(x.doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert collections.Counter(tuple(x)[:7] for x in got) == want
    assert all(not x.kept for x in got if x.base_failed)
    none = labels.limit(0)
    assert all(x.kept != x.base_failed for x in quality.quality_verdicts(docs, none).collect())
    assert quality.quality_verdicts(docs.limit(0), labels).count() == 0


def test_learnt_rule_separates(spark):
    clean, junk = " ".join(f"word{i % 40}x{i}" for i in range(80)), " ".join(f"w{i}###" for i in range(80))
    docs = spark.createDataFrame([(i, junk + " z" * (i % 7) if i % 4 == 0 else clean + " y" * (i % 5) + (" $" if i % 3 else "")) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)] + [(None, 0), (3, None), (4, 1)], "doc_id long, quality int")
    assert {x.doc_id for x in quality.quality_verdicts(docs, labels).filter("not kept").collect()} == set(range(0, 200, 4))


def test_conversations_like_sql(spark, tables, rows_like):
    rows_like(queries.op10_chat(spark, SMALL), tables, chat.CONVERSATIONS_SQL)


def test_typed_parts(spark):
    part = lambda **k: {x: k.get(x) for x in ("type", "text", "ref", "width", "height", "seconds", "pages")}
    rows = [
        (1, 2, "assistant", [part(type="text", text="see <turn> \\l "), part(type="image", ref="a.png", width=56, height=29), part(type="text", text="\\b</turn><image 1 4>")]),
        (1, 1, "user", [part(type="audio", ref="b.wav", seconds=2.0), part(type="document", ref="c.pdf", pages=2), part(type="text")]),
        (1, None, None, None),
        (None, 1, "assistant", [part(type="text", text="é\U0001f600")]),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    out = chat.format_conversations(turns).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_mask")))
    got = {x.conv_id: x for x in out.collect()}
    assert [(t.role, t.text, list(t.placeholders)) for t in got[1].back] == [("", "", []), ("user", "", ["<audio 1 25>", "<document 2 1600>"]), ("assistant", "see <turn> \\l \\b</turn><image 1 4>", ["<image 2 4>"])]
    assert got[1].loss == "see <turn> \\l \\b</turn><image 1 4>" and got[None].loss == "é\U0001f600"
    assert [tuple(a) for a in got[1].attachments] == [(2, 1, "audio", "b.wav", 25), (2, 2, "document", "c.pdf", 1600), (3, 2, "image", "a.png", 4)]
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_rare_entities_short_names_and_identifiers(spark):
    line = "Li has badge 77Q with zorblax and writes from li@site.org about gardens"
    rows = [(0, line)] + [(10 + i, "gardens and words has a badge with writes from about") for i in range(2000)]
    got = pii.personal_data_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {line[int(a) : int(b)]: kind for kind, a, b in (x.split(":") for x in got[[x.doc_id for x in got].index(0)].spans.split(","))}
    assert spans == {"li@site.org": "email", "77Q": "removed", "zorblax": "removed"} and all(x.spans == "" for x in got if x.doc_id)
    rows[0] = (0, "Ana wrote from x1@site.org")
    clean = {x.doc_id: x.text for x in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "Ana" not in clean[0] and "[EMAIL]" in clean[0]


def test_long_texts_and_taken_names(spark):
    """A text of very many lines, a line of very many addresses, and columns that bear the names the operator adds."""
    lines = "\n".join(f"some words here {i}" for i in range(100_000)) + "\nwrite to zorb ann@example.org"
    line = " ".join(f"u{i}@ex{i % 7}.org" for i in range(5000)) + " tail words"
    rows = [(1, lines, "own", 5, "r"), (2, line, None, None, None), (3, None, "own", 5, "r"), (4, "", "own", 5, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, __email int, row string")
    got = {x.doc_id: x for x in pii.personal_data_spans(docs).collect()}
    at = lines.index("ann@")
    assert (got[1].n_email, got[2].n_email, got[3].spans, got[4].spans) == (1, 5000, "", "")
    assert got[1].spans.startswith(f"email:{at}:{at + 15}")
    assert [tuple(map(int, x.split(":")[1:])) for x in got[2].spans.split(",") if x.startswith("email")] == [m.span() for m in re.finditer(r"\S+@\S+", line)]
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    clean = {x.doc_id: x for x in clean.collect()}
    assert clean[1].spans == "own" and clean[1]["__email"] == 5 and clean[1].row == "r" and clean[3].text is None and clean[4].text == ""
    assert clean[2].text.count("[EMAIL]") == 5000 and "@" not in clean[1].text
    found = pii.find_personal_data(docs)
    assert found.columns[:5] == docs.columns and found.columns[5:] == ["___email", "__ip", "__card", "__phone", "_spans"]
