import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from souk.llm import bpe, queries

PATH = public_tokenizers.path(queries.VOCABULARY)
SMALL = "/root/testdata/sf0.001"


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def strange_texts():
    r = random.Random(1)
    kinds = ["a", "É", "ß", " ", "  ", "\n", "\t", "\xa0", "\u3000", "\x1c", "\x85", "'s", "'LL", "7", "３", "²", "½", "日本", "\U0001f600", "\U00016ea7", "\u0558", "ʼ", "!", "<|endoftext|>", "e\u0301"]
    return ["".join(r.choices(kinds, k=r.randint(1, 30))) for _ in range(400)] + ["", "x" * 5000, " " * 3000, "ab" * 20_000, "a b " * 9000, "\n a", "a ", " a", "a  b"]


def test_encodes_like_the_library_and_round_trips(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(strange_texts())] + [(-1, None), (-1, None), (None, "é")], "doc_id long, text string")
    docs, engine = docs.union(more), reference()
    want = []
    for x in docs.collect():
        ids = engine.encode_ordinary(x.text or "")
        want.append((x.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((x.text or "").encode()).hexdigest()))
    got = bpe.encode_decode_digests(docs.withColumn("ids", docs.doc_id), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_tokens string")
    assert bpe.encode_decode_digests(docs, PATH, public_tokenizers.PATTERN).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe.encode(docs, PATH, public_tokenizers.PATTERN).count() == 0
