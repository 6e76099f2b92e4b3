"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct buckets of its words, word pairs and
pairs with one or two words left out (letters only, lower-cased, whole text).
The learner keeps one learning rate per coordinate; its L1 term leaves most weights at
exactly zero, so the model is a short list (bucket, weight) whose size is
bounded by ``2**bits`` and not by the corpus, small enough to broadcast.

Training reads at most ``max_rows`` labelled rows (a documented bound, chosen
by a hash of the id, the same rule at every size).  Features are made where the
rows lie; one task then runs the online learner over that bounded sample.
Scoring is per row without a shuffle.

Defined results: null or empty texts have no feature and get the base score;
without both classes among the training rows every score is the share of
class 1 (0 without any row).  A document with several label rows counts as toxic if
one of them says so; null ids and null labels teach nothing; repeated documents
are scored row by row.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROWS_PER_BATCH, WordHasher, letter_words, mix64, odd_constants, settings_during

THRESHOLD = 0.7
TEXTS = 1000  # whole texts, or lists of buckets, that a Python worker gets at once while training
_HASHER = WordHasher(200_000)


def forget_words() -> None:
    """Empties the hasher of this process when a task ends: its worker lives on and would keep the memory."""
    _HASHER.clear()


@dataclass(frozen=True)
class Settings:
    bits: int = 22
    max_rows: int = 24_000  # labelled rows that the learner reads at most
    gaps: tuple[int, ...] = (1, 2, 3)  # distance of the two words of a pair; 1 is the bigram
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 5
    seed: int = 6


@dataclass(frozen=True)
class Model:
    settings: Settings
    bias: float = 0.0
    base: float | None = None  # the one score of a model without both classes
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.settings.bits, np.float32)
        w[self.buckets] = self.weights
        return w


def held_out(doc_id: Column) -> Column:
    """Rows kept away from the learner: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def buckets_of(text: str | None, s: Settings) -> np.ndarray:
    """Buckets of all words, pairs and skip pairs of a text (with repeats)."""
    h = _HASHER.array([w.encode() for w in letter_words(text)])
    c = odd_constants(len(s.gaps) + 2, s.seed)
    with np.errstate(over="ignore"):
        grams = [h * c[0]] + [h[:-g] * c[1] + h[g:] * c[2 + k] for k, g in enumerate(s.gaps) if len(h) > g]
    return (mix64(np.concatenate(grams)) >> np.uint64(64 - s.bits)).astype(np.int64)


def ftrl(rows: list[tuple[int, np.ndarray]], s: Settings) -> tuple[float, np.ndarray]:
    """Bias and dense weights learnt from (label, distinct buckets) rows, in the order given."""
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    zb = nb = 0.0

    def weights(zi, ni):
        w = -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2)
        return np.where(np.abs(zi) <= s.l1, 0.0, w)

    for _ in range(s.epochs):
        for label, at in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            b = -zb / ((s.beta + np.sqrt(nb)) / s.alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(b + w.sum(), -35, 35)))
            g = p - label
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha * w
            n[at] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / s.alpha * b
            nb += g * g
    at, w = np.flatnonzero(np.abs(z) > s.l1), np.zeros(1 << s.bits)
    w[at] = weights(z[at], n[at])
    return -zb / ((s.beta + np.sqrt(nb)) / s.alpha), w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings(), hold_out=held_out) -> Model:
    s = settings
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~hold_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("__y"))
    # at most max_rows rows of an id and a number: bounded by the parameter, so small enough to send to all tasks
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id").limit(s.max_rows)
    rows = docs.select("doc_id", F.col("text").alias("__text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select(F.xxhash64("doc_id", F.lit(s.seed)).alias("__o"), "doc_id", "__y", "__text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [np.unique(buckets_of(t.as_py(), s)).astype("<i4").tobytes() for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(at, pa.binary())], names=["o", "doc_id", "y", "at"])
        forget_words()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # views of the batches' own memory, which goes back whole when the task ends
        data = [(y, np.frombuffer(at.as_buffer(), "<i4")) for b in batches for y, at in zip(b.column(2).to_pylist(), b.column(3))][: s.max_rows]
        total, ones = len(data), sum(y for y, _ in data)
        if 0 < ones < total:
            bias, w = ftrl(data, s)
            at = np.flatnonzero(w)
            at, value = [-1, *at.tolist()], [bias, *w[at].tolist()]
        else:
            at, value = [-2], [ones / total if total else 0.0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(value, pa.float64())], names=["bucket", "weight"])

    made = rows.mapInArrow(features, f"o long, doc_id {dict(docs.dtypes)['doc_id']}, y int, at binary")
    learnt = made.repartition(1).sortWithinPartitions("o", "doc_id").mapInArrow(learn, "bucket long, weight double")
    with settings_during(docs.sparkSession, {ROWS_PER_BATCH: str(TEXTS)}):
        model = learnt.toPandas()
    if not len(model):
        return Model(s, base=0.0)
    at, w = model["bucket"].to_numpy(), model["weight"].to_numpy()
    if at[0] == -2:
        return Model(s, base=float(w[0]))
    return Model(s, bias=float(w[at == -1][0]), buckets=at[at >= 0], weights=w[at >= 0].astype(np.float32))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out``, the probability of class 1."""
    s, shared = model.settings, docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at_text, cache = names.index(text), {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        if m.base is None:
            cache["w"] = w = m.dense()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                if m.base is not None:
                    sums = [m.base] * part.num_rows
                else:
                    sums = []
                    for t in part.column(at_text):
                        k = buckets_of(t.as_py(), s)
                        k = np.unique(k[w[k] != 0])  # each feature counts once
                        sums.append(float(1 / (1 + np.exp(-np.clip(m.bias + float(w[k].sum(dtype=np.float64)), -35, 35)))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sums, pa.float64())], names=[*names, out])
        forget_words()

    return docs.mapInArrow(run, docs.select("*").schema.add(out, "double", False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7) of every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, settings=settings))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    return score(docs, train(docs, labels, settings=settings), out="__toxicity").filter(F.col("__toxicity") < THRESHOLD).drop("__toxicity")
