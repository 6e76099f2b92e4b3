import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from souk.llm import jaccard, langid, toxicity
from souk.llm.common import ROWS_PER_BATCH

ALPHABETS = {"en": "thewandofi", "de": "schüeignuß", "fr": "éèlaquiouê", "es": "ñciónlosad"}


def sample(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = sorted(ALPHABETS)[i % 4]
        out.append((i, " ".join("".join(r.choices(ALPHABETS[lang], k=r.randint(2, 8))) for _ in range(r.randint(20, 60))), lang))
    return out


def test_language_of_held_out_texts(spark):
    rows = sample(240, 1)
    docs = spark.createDataFrame(rows + [(1000, None, "en"), (1001, "", None), (1002, "12 !? ½", "fr"), (1003, "x", None), (1003, "x", None)], "doc_id long, text string, lang string")
    got = langid.language_ids(docs.withColumn("score", F.lit("clash"))).collect()
    assert len(got) == docs.count()
    truth = {i: lang for i, _, lang in rows}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert len(held) > 30 and all(x.lang_pred == truth[x.doc_id] for x in held)
    assert {x.doc_id: x.lang_pred for x in got if x.doc_id in (1000, 1001, 1002)} == dict.fromkeys((1000, 1001, 1002), "und")
    assert all(0 <= x.score <= 1 for x in got)


def test_language_without_examples(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [tuple(x)[2:] for x in langid.language_ids(docs).collect()] == [("und", 0.0)]
    assert langid.language_ids(docs.limit(0)).count() == 0


def test_family_machines_come_first():
    r = langid.Settings(per_language=5)
    model = langid.fit([(lang, langid.vector(t, r)) for _, t, lang in sample(40, 2)], r)
    assert [p for p in model["machines"] if p[0] == "family"] == [("family", "germanic", "romance")]
    assert ("lang", "de", "en") in model["machines"] and ("lang", "de", "fr") not in model["machines"]


def test_toxic_words_are_learnt_and_clean_texts_left_alone(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    rows = []
    for i in range(600):
        w = [word() for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            w[r.randrange(30)] = r.choice(["NASTY!!", "awful,", "vile"])
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (0, rows[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, 0), (5, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs.withColumn("score", F.lit("clash")), labels).collect()
    assert len(got) == 603 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in got)
    held = [x for x in got if x.held_out and x.doc_id < 600]
    assert all(x.predicted == (x.doc_id % 5 == 0) for x in held)
    assert all(x.predicted == 0 for x in got if x.doc_id >= 9000)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} >= {9000, 9001, 1, 2}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {x.score for x in toxicity.toxicity_scores(docs, none).collect()} == {0.0}
    assert toxicity.toxicity_scores(docs.limit(0), none).count() == 0


def test_every_language_is_learnt_from_a_bounded_choice(spark):
    """More languages than a hundred, each of one made-up letter pair; copies of a row count once in the choice."""
    few = langid.Settings(per_language=3, epochs=3, bits=12)
    names = [f"x{i:03d}" for i in range(104)]
    text = lambda i, k: " ".join([chr(0x4E00 + i) * 3, chr(0x4E00 + i) * (k + 2)])
    rows = [(10 * i + k, text(i, k), lang) for i, lang in enumerate(names) for k in range(2)] + [(7, "aaa bbb", "x000")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.train(docs, few, hold_out=lambda _: F.lit(False))
    assert list(model["families"]) == [f"only {x}" for x in names] and len(model["machines"]) == 104 * 103 // 2
    said = langid.predict(docs.filter("doc_id <> 7").withColumn("lang_pred", F.lit(1)), model, few)
    assert said.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert sum(x.lang == x.lang_pred for x in said.collect()) >= 200


def test_slices_of_a_long_text_add_up(monkeypatch):
    s, t = langid.Settings(), "some words of a text " * 120_000  # more than two slices
    at, share = langid.vector(t, s)
    one, part = langid.vector(t[: 21 * 40_000], s)
    assert (at == one).all() and abs(share - part).max() < 1e-2 and abs(share.sum() - s.scale) < 1e-3


def test_idle_workers_keep_no_words(spark):
    """Python workers live on after a task; what they remember of its words goes with the task."""
    docs = spark.createDataFrame([(i, " ".join(f"{c}{i}" for c in "abcdefgh")) for i in range(64)], "doc_id long, text string").repartition(8)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    assert toxicity.toxicity_scores(docs, labels).count() == 64 and jaccard.similar_documents(docs).count() == 64

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"words": [len(toxicity._HASHER) + len(jaccard._HASHER)] * b.num_rows})

    assert spark.range(0, 64, 1, 8).mapInArrow(held, "words long").agg(F.max("words")).first()[0] == 0


def test_training_reads_small_batches_and_restores_the_setting(spark, monkeypatch):
    """The learner gets all rows in order, however few come at once."""
    docs = spark.createDataFrame([(i, f"good word{i % 7}" if i % 2 else f"vile word{i % 5}") for i in range(90)] + [(500, "...")], "doc_id long, text string").repartition(3)
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    before = spark.conf.get(ROWS_PER_BATCH)
    want = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "TEXTS", 4)
    got = toxicity.train(docs, labels)
    assert spark.conf.get(ROWS_PER_BATCH) == before
    assert want.bias == got.bias and np.array_equal(want.buckets, got.buckets) and np.array_equal(want.weights, got.weights) and len(got.buckets)
