"""The pipeline against a plain version of each stage, on a small table."""

import collections
import hashlib
import math

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from souk.llm import bpe, mixing, pii, queries, toxicity
from souk.llm.common import table
from tests.llm.test_jaccard import brute
from tests.llm.test_native import base

SMALL = "/root/testdata/sf0.001"


def copies(doc_id, rate):
    chunks = max(1, math.ceil(rate / mixing.CHUNK))
    n = 0
    for i in range(1, chunks + 1):
        u = int(hashlib.md5(f"5:{doc_id}:{i}".encode()).hexdigest()[:13], 16) / 2.0**52
        k, p = 0, math.exp(-rate / chunks)
        below = p
        while u >= below and k < mixing.TERMS:
            k += 1
            p *= rate / chunks / k
            below += p
        n += k
    return n


def test_stages_and_run(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "personal_data", "mixing", "encoding"]
    docs = table(spark, SMALL, "documents")
    out = docs
    seen = [sorted(docs.collect())]
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, out, SMALL).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == docs.columns
        seen.append(out.collect())
    scores = {x.doc_id: x.score for x in toxicity.toxicity_scores(docs, table(spark, SMALL, "labels")).collect()}
    assert sorted(seen[1]) == [x for x in seen[0] if scores[x.doc_id] < 0.7]
    comp = brute([(x.doc_id, x.text) for x in seen[1]])
    assert sorted(seen[2]) == [x for x in sorted(seen[1]) if comp[x.doc_id][1] == x.doc_id]
    terms = {x.doc_id: x.spans for x in pii.personal_data_spans(spark.read.parquet(f"{tmp_path}/1")).collect()}
    clean = {}
    for x in seen[2]:
        t, at = "", 0
        spans = [(int(a), int(b), k) for k, a, b in (s.split(":") for s in terms[x.doc_id].split(",") if s)]
        assert [(k, a, b) for a, b, k in spans if k in pii.KINDS] == base(x.text)
        for a, b, kind in sorted(spans):
            if a >= at:
                t += x.text[at:a] + pii.MARKS[kind]
            at = max(at, b)
        clean[x.doc_id] = t + x.text[at:]
    assert {x.doc_id: x.text for x in seen[3]} == clean
    size = collections.Counter(x.source for x in seen[3])
    weight = sum(math.sqrt(n) for n in size.values())
    want = collections.Counter({x.doc_id: copies(x.doc_id, sum(size.values()) * math.sqrt(size[x.source]) / weight / size[x.source]) for x in seen[3]})
    assert collections.Counter(x.doc_id for x in seen[4]) == +want
    engine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY)), special_tokens={})
    assert all(np.frombuffer(x.ids, "<u4").tolist() == engine.encode_ordinary(clean[x.doc_id]) and 4 * x.n_tokens == len(x.ids) for x in seen[5])
    assert sorted(map(tuple, seen[5])) == sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))


def test_empty_table_and_extra_columns(spark, tmp_path):
    docs = table(spark, SMALL, "documents").limit(0)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0
