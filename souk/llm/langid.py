"""Language identification by hierarchical discrimination.

The language family is predicted first; one-versus-one linear support vector
machines then separate the languages inside it.  Features are hashed byte
2-, 3- and 4-grams of the letters of the whole text, as shares of all grams, so
a score is the mean weight of a text's grams.

Families come from a table of well-known codes; a code not listed is a family of its own.
Learning reads at most ``per_language`` different texts of each language (a documented bound on
labelled rows, picked by a hash of id and text; the hash is cut at a bound that follows from the language's
count, so few rows more than those are ever ranked).  Every language is learnt.  A machine's weights are
kept for the buckets that its texts hold, one row per machine.  Prediction is per row without a shuffle: the
machines of families first, then only those inside the chosen family.

Defined results: ``und`` with score 0 for a null text or a text without a
letter, and for every text when nothing could be learnt; one known language only: that
language with score 1.  Null languages teach nothing; repeated rows are
predicted one by one; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import letter_words, odd_constants

#: Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "indo-aryan": ("hi", "bn", "ur", "mr", "ne", "pa", "gu"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt", "am"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "gd", "br"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


@dataclass(frozen=True)
class Settings:
    bits: int = 17
    sizes: tuple[int, ...] = (2, 3, 4)
    per_language: int = 800  # texts of a language that the learner reads at most
    cost: float = 10.0
    epochs: int = 12
    scale: float = 30.0  # brings shares of grams to vectors of a length near 1
    seed: int = 3


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(text: str | None, s: Settings) -> Iterator[np.ndarray]:
    """Buckets of the text's grams, in slices of bounded size; nothing if it has no letter."""
    words = letter_words(text)
    if not any(c.isalpha() for w in words for c in w):
        return
    data = np.frombuffer((" " + " ".join(words) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    longest, c = max(s.sizes), odd_constants(len(s.sizes), s.seed).astype(np.uint32)
    for at in range(0, len(data), 1 << 20):
        part = data[at : at + (1 << 20) + longest - 1].astype(np.uint32)
        end = min(1 << 20, len(data) - at)
        for k, size in enumerate(s.sizes):
            n = min(end, len(part) - size + 1)
            if n > 0:
                v = part[:n].copy()
                for j in range(1, size):
                    v = (v << np.uint32(8)) | part[j : j + n]
                with np.errstate(over="ignore"):
                    yield (((v + np.uint32(k)) * c[k]) >> np.uint32(32 - s.bits)).astype(np.int32)


def vector(text: str | None, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sparse shares of grams: buckets and values."""
    parts = grams(text, s)
    first = [x for _, x in zip(s.sizes, parts)]  # those of one slice, which is the whole of most texts
    if not first:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at, count = np.unique(np.concatenate(first), return_counts=True)
    if len(at) and (rest := next(parts, None)) is not None:
        whole = np.bincount(at, count, 1 << s.bits) + np.bincount(rest, minlength=1 << s.bits)
        for x in parts:
            whole += np.bincount(x, minlength=1 << s.bits)
        at = np.flatnonzero(whole).astype(np.int32)
        count = whole[at]
    return at, (s.scale * count / count.sum()).astype(np.float32)


def svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by dual coordinate descent; weights and bias."""
    w, bias, a = np.zeros(1 << s.bits, np.float32), 0.0, np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    cost = np.where(y > 0, s.cost * len(y) / (2 * max(1, (y > 0).sum())), s.cost * len(y) / (2 * max(1, (y < 0).sum())))
    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            new = min(max(a[i] - (y[i] * (float(w[at] @ v) + bias) - 1) / norm[i], 0.0), cost[i])
            step = (new - a[i]) * y[i]
            if step:
                w[at] += np.float32(step) * v
                bias += step
                moved = max(moved, abs(step))
                a[i] = new
        if moved < 1e-3:
            break
    return w, bias


def fit(examples: list[tuple[str, tuple[np.ndarray, np.ndarray]]], s: Settings) -> dict:
    """{"families": {family: [languages]}, "machines": {(level, a, b): (buckets, weights, bias)}}."""
    langs = sorted({lang for lang, _ in examples})
    families = {f: [x for x in langs if family(x) == f] for f in sorted({family(x) for x in langs})}
    pairs = [("family", a, b) for a, b in combinations(families, 2)]
    pairs += [("lang", a, b) for members in families.values() for a, b in combinations(members, 2)]
    machines = {}
    for level, a, b in pairs:
        of = family if level == "family" else str
        chosen = [(v, 1 if of(lang) == a else -1) for lang, v in examples if of(lang) in (a, b)]
        w, bias = svm([v for v, _ in chosen], np.array([y for _, y in chosen]), s)
        at = np.flatnonzero(w).astype(np.int32)
        machines[level, a, b] = (at, w[at], bias)
    return {"families": families, "machines": machines}


def train(docs: DataFrame, settings: Settings = Settings(), hold_out=held_out) -> dict:
    s = settings
    seen = docs.select("doc_id", F.col("text").alias("__text"), F.col("lang").alias("__lang"))
    seen = seen.filter(F.col("__lang").isNotNull() & F.col("__text").isNotNull() & F.col("doc_id").isNotNull() & ~hold_out(F.col("doc_id")))
    counts = seen.groupBy("__lang").agg(F.count(F.lit(1)).alias("__count"))
    place = F.xxhash64("doc_id", "__text", F.lit(s.seed)).alias("__place")
    share = F.pmod(F.col("__place"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    near = seen.select("*", place).join(counts, "__lang").filter(share < (2.0 * s.per_language + 100) / F.col("__count"))
    # copies of one row have one place, so they are one before the ranking
    once = near.groupBy("__lang", "doc_id", "__place").agg(F.min("__text").alias("__text"))
    order = Window.partitionBy("__lang").orderBy("__place", "doc_id")
    rows = once.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= s.per_language).select("__lang", "doc_id", "__text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [vector(t.as_py(), s) for t in b.column(2)]
            at, value = ([x[k].tobytes() for x in made] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(at, pa.binary()), pa.array(value, pa.binary())], names=["lang", "doc_id", "at", "value"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(lang, (np.frombuffer(at, np.int32), np.frombuffer(v, np.float32))) for b in batches for lang, at, v in zip(*(b.column(k).to_pylist() for k in (0, 2, 3))) if at]
        model = fit(rows, s)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps({"families": model["families"]})], pa.binary())], names=["model"])
        for machine in model["machines"].items():
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], names=["model"])

    made = rows.mapInArrow(features, f"lang string, doc_id {dict(docs.dtypes)['doc_id']}, at binary, value binary")
    got = made.repartition(1).sortWithinPartitions("lang", "doc_id").mapInArrow(learn, "model binary").collect()
    parts = [pickle.loads(bytes(x.model)) for x in got]
    return {"families": next((x["families"] for x in parts if isinstance(x, dict)), {}), "machines": dict(x for x in parts if isinstance(x, tuple))}


class Predictor:
    """Votes of the family machines, then of the machines inside the family."""

    def __init__(self, model: dict, s: Settings):
        self.s, self.m, self.groups = s, model, {}

    def group(self, level: str, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of each bucket in the weights of the machines between ``names``, those rows, and the biases; row 0 is empty."""
        if (level, names) not in self.groups:
            machines = [self.m["machines"][level, a, b] for a, b in combinations(names, 2)]
            row, used = np.zeros(1 << self.s.bits, np.int32), np.unique(np.concatenate([at for at, _, _ in machines]))
            row[used] = np.arange(1, len(used) + 1)
            w = np.zeros((len(used) + 1, len(machines)), np.float32)
            for k, (at, value, _) in enumerate(machines):
                w[row[at], k] = value
            self.groups[level, names] = row, w, np.array([bias for _, _, bias in machines])
        return self.groups[level, names]

    def winner(self, level: str, names: list[str], at: np.ndarray, share: np.ndarray) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        row, w, bias = self.group(level, tuple(names))
        margin = bias.copy()
        for k in range(0, len(at), 4096):
            margin += share[k : k + 4096] @ w[row[at[k : k + 4096]]]
        votes, least = dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for v, (a, b) in zip(margin, combinations(names, 2)):
            votes[a if v >= 0 else b] += 1
            least[a], least[b] = min(least[a], v), min(least[b], -v)
        best = max(names, key=lambda x: (votes[x], least[x]))
        return best, float(1 / (1 + np.exp(-2 * np.clip(least[best], -30, 30))))

    def __call__(self, text: str | None) -> tuple[str, float]:
        at, share = vector(text, self.s)
        if not len(at) or not self.m["families"]:
            return "und", 0.0
        fam, sure = self.winner("family", list(self.m["families"]), at, share)
        lang, within = self.winner("lang", self.m["families"][fam], at, share)
        return lang, sure * within


def predict(docs: DataFrame, model: dict, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """All columns of ``docs``, lang_pred and score; own columns of these two names are replaced."""
    docs = docs.drop("lang_pred", "score")
    shared, names, s = docs.sparkSession.sparkContext.broadcast(model), docs.columns, settings
    at_text = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        say = Predictor(shared.value, s)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                said = [say(t.as_py()) for t in part.column(at_text)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, docs.select("*").schema.add("lang_pred", "string", False).add("score", "double", False))


def language_ids(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    said = predict(docs.select("doc_id", "text"), train(docs, settings), settings)
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
