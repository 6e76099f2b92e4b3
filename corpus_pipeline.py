"""The training-corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. toxicity: documents that the classifier rejects go;
2. near copies: one document of each group of similar word shingles stays;
3. personal data: base spans and disclosing terms are replaced;
4. mixing: documents are replicated to the sources' target weights and shuffled;
5. encoding: token ids of every remaining document.

A stage sees all rows that its predecessor kept.  Null ids, null or empty texts and
repeated rows are treated as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from souk.llm import bpe, jaccard, mixing, pii, toxicity
from souk.llm.common import Stage, table
from souk.llm.queries import VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_of_each(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=("doc_id", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", sanitise),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL cannot express the classifier, the groups' components or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = table(spark, sf_dir, "documents"), Stage(spark, "pipeline")
    for name, step in STAGES[:-1]:
        docs = stage.write(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
