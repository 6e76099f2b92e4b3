"""Passages that repeat across documents, by content-defined chunking.

A gear rolling hash over the last 16 bytes cuts a text wherever it falls below
a bound, on average every ``mean`` bytes.  Cuts depend on the bytes around
them only, so an insertion moves no cut outside its neighbourhood, and a
repeated passage has the same chunks wherever it stands, but for the pieces at its ends.
Two adjacent chunks form a unit with a 64-bit digest.  A digest with two
different documents is repeated.

Runs of adjacent repeated units are the search for candidates: a run is one if a passage of
``words`` words can lie inside it, the chunks beside it and the ``REACH`` bytes before them (cuts
there depend on the text before the passage).  Each unit of a candidate is then laid beside
its place in a partner's text, the first document that holds the unit or, in that document itself, the last one,
and both texts are compared to the exact first and last whole word that they share.
That passage counts if it holds ``words`` words.

A candidate needs three cuts in common: with a mean of 32 bytes, a passage of about 300 bytes has fewer once
in some 170 cases, and longer ones rarely.

Digests are counted by a plain aggregation (smallest and largest document
id, combined before the shuffle), so a passage in a third of all documents
is one row per task; the join that brings repeated digests back to their places has two
shuffled sides, of which Spark can split a large key.

Defined results: null and empty texts, texts that repeat only themselves, and rows
whose id is null give no rows; rows that repeat an id are one document; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, mix64, odd_constants

LONGEST = 1 << 16  # bytes of a chunk; longer ones are cut from their start
REACH = 16  # bytes that the rolling hash depends on
_GEAR = (odd_constants(256, 8) >> np.uint64(40)).astype(np.uint16)
_BYTE = odd_constants(256, 80)
_PLACE = np.ones(LONGEST, np.uint64)
with np.errstate(over="ignore"):
    _PLACE[1:] = odd_constants(1, 81)[0]
    _PLACE = np.multiply.accumulate(_PLACE)
_PAIR = odd_constants(3, 82)
_GAPS = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
_EXACT = [pa.int64()] * 6 + [pa.list_(pa.int32())]


@dataclass(frozen=True)
class Settings:
    mean: int = 32
    words: int = 50  # of a passage, from its exact first to its exact last word



def cuts(data: np.ndarray, mean: int) -> np.ndarray:
    """Start of each chunk of the bytes, and their end."""
    g = _GEAR[data]
    h = np.zeros(len(data), np.uint16)
    for j in range(min(REACH, len(data))):
        h[j:] += g[: len(data) - j] << np.uint16(j)
    starts = np.r_[0, np.flatnonzero(h < (1 << 16) // mean) + 1, len(data)]
    starts = np.unique(starts)
    if len(starts) > 1 and np.diff(starts).max() > LONGEST:
        starts = np.unique(np.concatenate([np.arange(a, b, LONGEST) for a, b in zip(starts[:-1], starts[1:])] + [[len(data)]]))
    return starts


def units(text: str, s: Settings) -> tuple[np.ndarray, ...]:
    """digest, start, end (code points), words before start and before end, and the same one chunk further out, of each pair of adjacent chunks."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    at = cuts(data, s.mean)
    n = len(at) - 1
    if n < 1:
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    digest, points, words = np.zeros(n, np.uint64), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    k = 0
    while k < n:  # slices of whole chunks, so memory stays small for very long texts
        end = max(k + 1, int(np.searchsorted(at, at[k] + (1 << 21), side="right")) - 1)
        part, inner = data[at[k] : at[end]], at[k:end] - at[k]
        place = np.arange(len(part)) - np.repeat(inner, np.diff(at[k : end + 1]))
        with np.errstate(over="ignore"):
            digest[k:end] = np.add.reduceat(_BYTE[part] * _PLACE[place], inner)
        points[k + 1 : end + 1] = np.add.reduceat((part & 0xC0) != 0x80, inner, dtype=np.int64)
        gap = (part == 32) | ((part >= 9) & (part <= 13))
        before = np.r_[at[k] == 0 or data[at[k] - 1] in b" \t\n\x0b\x0c\r", gap[:-1]]
        words[k + 1 : end + 1] = np.add.reduceat(~gap & before, inner, dtype=np.int64)
        k = end
    points, words = points.cumsum(), words.cumsum()
    with np.errstate(over="ignore"):
        digest = mix64(digest + np.diff(at).astype(np.uint64) * _PAIR[2])
        if n > 1:
            digest = mix64(digest[:-1] * _PAIR[0] + digest[1:] * _PAIR[1])
    m = len(digest)
    near = np.arange(m)
    return digest.view(np.int64), points[:m], points[-m:], words[:m], words[-m:], words[np.maximum(near - 1, 0)], words[np.minimum(near + n - m + 2, n)]


def _rows(docs: DataFrame, s: Settings, places: bool) -> DataFrame:
    """(digest, doc_id) of each document once, or (digest, doc_id, text_id, i, start, end, w0, w1, v0, v1) of every unit."""
    chosen = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                made = [units(t.as_py(), s) for t in part.column(2)]
                if not places:
                    made = [(np.unique(x[0]),) for x in made]
                n = [len(x[0]) for x in made]
                each = [np.concatenate([x[k] for x in made]) for k in range(len(made[0]))]
                own = np.repeat(part.column(0).to_numpy(), n)
                if places:
                    i = np.concatenate([np.arange(x) for x in n]).astype(np.int32)
                    text = np.repeat(part.column(1).to_numpy(), n)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (each[0], own, text, i, *(x.astype(np.int32) for x in each[1:]))], names=["digest", "doc_id", "text_id", "i", "start", "end", "w0", "w1", "v0", "v1"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(each[0]), pa.array(own)], names=["digest", "doc_id"])

    return chosen.mapInArrow(run, "digest long, doc_id long, text_id long, i int, start int, end int, w0 int, w1 int, v0 int, v1 int" if places else "digest long, doc_id long")


def _shared(a: str, i: int, b: str, j: int, step: int) -> int:
    """Number of equal characters of ``a`` from i and ``b`` from j on, to the right (step 1) or before them (step -1)."""
    most = min(len(a) - i, len(b) - j) if step > 0 else min(i, j)
    same = (lambda m, n: a[i + m : i + n] == b[j + m : j + n]) if step > 0 else (lambda m, n: a[i - n : i - m] == b[j - n : j - m])
    n, size = 0, 64
    while n < most and size:
        end = min(n + size, most)
        if same(n, end):
            n, size = end, size * 2
        else:
            most, size = end - 1, max((end - n) // 2, 1)
    return n


def passage(a: str, i: int, b: str, j: int) -> tuple[int, int]:
    """Start and end in ``a`` of the whole words that both texts share around the places i and j."""
    left, right = _shared(a, i, b, j, -1), _shared(a, i, b, j, 1)
    start, end, shift = i - left, i + right, j - i
    inside = lambda t, k: 0 < k < len(t) and t[k - 1] not in _GAPS and t[k] not in _GAPS
    if start < end and (inside(a, start) or inside(b, start + shift)):
        start = next((k for k in range(start, end) if a[k] in _GAPS), end)
    if start < end and (inside(a, end) or inside(b, end + shift)):
        end = next((k for k in range(end, start, -1) if a[k - 1] in _GAPS), start)
    while start < end and a[start] in _GAPS:
        start += 1
    while start < end and a[end - 1] in _GAPS:
        end -= 1
    return start, end


def _exact(pairs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, text_id, partner, start, end, n_words, at) of the passages of pairs; ``at`` has the words' starts where the document is the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {name: b.column(name) for name in b.schema.names}
            offsets, at = c["places"].offsets.to_pylist(), c["places"].values
            starts, shifts = at.field(0).to_numpy().astype(np.int64), at.field(1).to_numpy().astype(np.int64) - at.field(0).to_numpy()
            for k in range(b.num_rows):
                a, other, found, ends = c["text"][k].as_py(), c["ptext"][k].as_py(), {}, {}
                inner = slice(offsets[k], offsets[k + 1])
                for i, shift in sorted(zip(starts[inner].tolist(), shifts[inner].tolist())):
                    if i >= ends.get(shift, 0):
                        start, end = passage(a, i, other, i + shift)
                        ends[shift] = max(end, i + 1)
                        words = [start + w.start() for w in _WORD.finditer(a[start:end])] if end - start >= 2 * s.words - 1 else []
                        if len(words) >= s.words:
                            found[start, end] = words
                if found:
                    own = tuple(c[name][k].as_py() for name in ("doc_id", "text_id", "partner"))
                    rows = [(*own, *x, len(w), w if own[0] < own[2] else None) for x, w in found.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), _EXACT)], names=["doc_id", "text_id", "partner", "start", "end", "n_words", "at"])

    return pairs.mapInArrow(run, "doc_id long, text_id long, partner long, start long, end long, n_words long, at array<int>")


def _spans(own: int, found: list[dict]) -> list[tuple[int, int, int, int]]:
    """start, end, n_words, first_doc_id: copied passages that no longer one holds, then what is left of those that begin here."""
    out, covered = [], -1
    for x in sorted((x for x in found if x["partner"] < own), key=lambda x: (x["start"], -x["end"], x["partner"])):
        if x["end"] > covered:
            covered = x["end"]
            out.append((x["start"], x["end"], x["n_words"], x["partner"]))
    copied, pieces = list(out), []
    for x in sorted((x for x in found if x["partner"] > own), key=lambda x: (x["start"], -x["end"])):
        if pieces and x["start"] < pieces[-1][1]:
            pieces[-1][1], pieces[-1][2] = max(pieces[-1][1], x["end"]), pieces[-1][2] | set(x["at"])
        else:
            pieces.append([x["start"], x["end"], set(x["at"])])
    for start, end, words in pieces:
        for a, b in [*((c[0], c[1]) for c in copied if c[1] > start and c[0] < end), (end, end)]:
            n = sum(start <= w < a for w in words)
            if n:
                out.append((start, a, n, own))
            start = max(start, b)
    return out


def repeated_passages(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """doc_id, start, end (code points), n_words, first_doc_id, is_first of each passage that another document repeats.

    The span stands word for word in ``first_doc_id``.  A passage that begins here (``is_first``) is counted whole
    for the word limit, with copied passages in it, but its spans are the parts of it that are not copied."""
    stage = stage or Stage(docs.sparkSession, "chunks")
    seen = _rows(docs, settings, False).groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = stage.write(seen.filter("first < last"), "repeated")
    partner = F.when(F.col("first") < F.col("doc_id"), F.col("first")).otherwise(F.col("last")).alias("partner")
    found = _rows(docs, settings, True).join(repeated, "digest")
    found = stage.write(found.select("digest", "doc_id", "text_id", "i", "start", "v0", "v1", partner, F.col("doc_id").isin(F.col("first"), F.col("last")).alias("place")), "found")
    text = Window.partitionBy("doc_id", "text_id").orderBy("i")
    runs = found.withColumn("fresh", F.coalesce(F.col("i") - F.lag("i").over(text) > 1, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("fresh").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc_id", "text_id", "run")
    # before the chunks beside a run, a passage can hold the words of REACH bytes and a part of one more
    runs = runs.withColumn("reach", F.max("v1").over(run) - F.min("v0").over(run) + REACH // 2 + 1).filter(F.col("reach") >= settings.words)
    places = found.filter("place").groupBy("digest", F.col("doc_id").alias("partner")).agg(F.min(F.struct("text_id", "start")).alias("p"))
    hits = runs.select("digest", "doc_id", "text_id", "start", "partner").join(places, ["digest", "partner"])
    pairs = hits.groupBy("doc_id", "text_id", "partner", F.col("p.text_id").alias("ptext_id")).agg(F.collect_list(F.struct("start", F.col("p.start").alias("pstart"))).alias("places"))
    pairs = stage.write(pairs, "pairs")
    # a text is written with its links, so that it moves once to them and once more to each partner; partners alone are shuffled again
    links = pairs.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("partner", "ptext_id", "places")).alias("links"))
    partners = pairs.select(F.col("partner").alias("doc_id"), F.col("ptext_id").alias("text_id")).distinct().withColumn("is_partner", F.lit(True))
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    texts = texts.join(links.join(partners, ["doc_id", "text_id"], "full"), ["doc_id", "text_id"])
    texts = stage.write(texts.dropDuplicates(["doc_id", "text_id"]), "texts")
    own = texts.filter("links is not null").select("doc_id", "text_id", "text", F.explode("links").alias("l")).select("doc_id", "text_id", "text", "l.*")
    others = texts.filter("is_partner").select(F.col("doc_id").alias("partner"), F.col("text_id").alias("ptext_id"), F.col("text").alias("ptext"))
    exact = stage.write(_exact(own.join(others, ["partner", "ptext_id"]), settings), "exact", 512)
    of_text = exact.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("partner", "start", "end", "n_words", "at")).alias("found"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(r["doc_id"], *x, x[3] == r["doc_id"]) for r in b.to_pylist() for x in _spans(r["doc_id"], r["found"])]
            names = ["doc_id", "start", "end", "n_words", "first_doc_id", "is_first"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.bool_() if k == 5 else pa.int64()) for k in range(6)], names=names)

    return of_text.mapInArrow(spans, "doc_id long, start long, end long, n_words long, first_doc_id long, is_first boolean")


def without_repeats(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """``docs`` with every repeated passage cut out, except in the document that has it first."""
    spans = repeated_passages(docs, settings, stage).filter("not is_first").groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    piece = lambda a, n: F.substring(F.col("text"), (a + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int"))
    step = lambda acc, x: F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], piece(acc["at"], x["start"] - acc["at"])).alias("out"))
    cut = F.aggregate("__spans", zero, step, lambda acc: F.concat(acc["out"], piece(acc["at"], F.length("text"))))
    return docs.join(spans, "doc_id", "left").withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
