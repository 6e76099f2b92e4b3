"""Periodic runs of words, found online by a suffix automaton whose link tree is accessed like a link-cut tree.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends.  Wanted are runs of at least ``least_words`` words and ``least_periods`` periods (2 or more).

Words are appended one by one to a suffix automaton.  In the tree of its suffix links, the path from a
prefix to the root holds all its suffixes, and a node's colour is the place where its strings ended last.  Appending word i
recolours the whole path of prefix i, as the access operation of a link-cut tree makes one preferred path.  Nodes of one
colour c always are one segment of the path of prefix c, cut off at the top where a later path joined it, so a
segment is kept as two numbers, the length ``low`` and the node ``up`` where it is cut, and a node's colour is
found by following cut places with path compression.  An access steps over whole segments, O(log n) of them in the mean.
Each segment that is entered at a node of length l with the colour c tells that the last l words occurred last
i - c words earlier: if that distance is within l, the last l + (i - c) words are a square of this period, and the
period is the smallest one.  Squares are extended word by word to the maximal run, each run once.

Before that, stretches without a run are left out, exactly: every run of at least ``least_words`` words and ``least_periods``
periods is at least two periods and w = least_words * (least_periods - 2) / least_periods words long, so each
of its w-grams occurs twice in the document.  The automaton runs on each maximal stretch of words whose w-grams occur twice.

Defined results: null and empty texts have no words and no runs.  A very long text is one document; memory
follows its longest repeating stretch.  Rows are independent: null or repeated ids and repeated rows change
nothing, other columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, odd_constants

_RUN = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@dataclass(frozen=True)
class Settings:
    least_words: int = 24
    least_periods: int = 3

    def __post_init__(self):
        if self.least_periods < 2 or self.least_words < 2:
            raise ValueError("a run has at least two periods and two words")

    @property
    def gram(self) -> int:
        """Words w such that every w-gram inside a wanted run occurs twice."""
        return self.least_words * (self.least_periods - 2) // self.least_periods


def stretches(ids: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Start and end of the maximal stretches all of whose grams occur twice (equal hashes only widen them)."""
    n = len(ids) - gram + 1
    if gram < 1:
        return [(0, len(ids))]
    if n < 2:
        return []
    with np.errstate(over="ignore"):
        h, h0 = np.zeros(n, np.uint64), mix64(ids.astype(np.uint64) + np.uint64(1))
        for k, c in enumerate(odd_constants(gram, 12)):
            h += h0[k : k + n] * c
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(n + 2, np.int8)
    twice[order[1:][same] + 1] = twice[order[:-1][same] + 1] = 1
    edge = np.diff(twice)
    return [(int(a), int(b) + gram - 1) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def runs_in(t: list[int], s: Settings) -> list[tuple[int, int, int]]:
    """(start, length, period) of the wanted runs of a sequence of non-negative integers, by start, then period."""
    n, least, periods = len(t), s.least_words, s.least_periods
    # states: first transition (word, target), further ones in dictionaries; suffix link, length, colour as last known
    word, target, more = array("q", [-1]), array("i", [0]), {}
    link, size, colour = array("i", [-1]), array("i", [0]), array("i", [-1])
    low, up = array("i"), array("i")  # of a colour's segment: where a later path cut it
    out, ends, last = [], {}, 0
    for i in range(n):
        c, cur, p, q = t[i], len(link), last, -1
        word.append(-1), target.append(0), link.append(0), size.append(i + 1), colour.append(i)
        while p >= 0:
            if word[p] == c:
                q = target[p]
                break
            if word[p] < 0:
                word[p], target[p] = c, cur
            else:
                m = more.get(p)
                if m is None:
                    more[p] = {c: cur}
                elif c in m:
                    q = m[c]
                    break
                else:
                    m[c] = cur
            p = link[p]
        if q >= 0:
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                k = colour[q]
                while low[k] >= size[q]:
                    k = colour[up[k]]
                clone = len(link)
                word.append(word[q]), target.append(target[q]), link.append(link[q]), size.append(size[p] + 1), colour.append(k)
                if q in more:
                    more[clone] = more[q].copy()
                while p >= 0:
                    if word[p] == c:
                        if target[p] != q:
                            break
                        target[p] = clone
                    elif more[p][c] != q:
                        break
                    else:
                        more[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last, v = cur, link[cur]
        while v:  # access: one step per segment of the path
            long, k = size[v], colour[v]
            while low[k] >= long:
                k = colour[up[k]]
            colour[v], d = i, i - k
            # d <= long is a square; only those long enough for a wanted run are extended
            if long + d >= least and long >= (periods - 1) * d and ends.get(d, -1) < i:
                a, b = i - long - d + 1, i + 1
                while a and t[a - 1] == t[a - 1 + d]:
                    a -= 1
                while b < n and t[b] == t[b - d]:
                    b += 1
                ends[d] = b - 1
                out.append((a, b - a, d))
            above = up[k]
            low[k], up[k], v = long, v, above
        low.append(0), up.append(0)
    return sorted(out, key=lambda x: (x[0], x[2]))


def periodic_runs(words: list, s: Settings = Settings()) -> list[tuple[int, int, int]]:
    """(start, length, period) of the wanted runs of a document's words."""
    if len(words) < s.least_words:
        return []
    number = {w: k for k, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    out = []
    for a, b in stretches(ids, s.gram):
        if b - a >= s.least_words:
            out += [(a + x, length, q) for x, length, q in runs_in(ids[a:b].tolist(), s)]
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [w for w, s in zip(words, stays) if s]


def document_runs(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed (the kept words joined by one space) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                counts, found, kept = [], [], []
                for text in part.column(1):
                    words = text.as_buffer().to_pybytes().split() if text.is_valid else []  # bytes: split at ASCII white space
                    runs = periodic_runs(words, settings)
                    counts.append(len(words))
                    found.append([{"start": x, "length": n, "period": q} for x, n, q in runs])
                    kept.append(b" ".join(collapse(words, runs) if runs else words))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(found, _RUN_TYPE), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").alias("__text")).mapInArrow(run, f"doc_id long, n_words long, runs {_RUN}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by the checksum of its id, the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (F.length("text") > 0), F.when(n > 0, planted).otherwise(F.col("text"))).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period (ties: smallest start, then period)."""
    exponent = lambda a, b: a["length"] * b["period"]
    by = lambda a, b: F.when(exponent(a, b) != exponent(b, a), exponent(b, a) - exponent(a, b)).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
    return F.get(F.array_sort(runs, lambda a, b: F.signum(by(a, b)).cast("int")), F.lit(0))


def run_digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Number of runs, the strongest one, and digests of all runs and of the collapsed text, of every row of ``docs``."""
    best = F.col("best")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    all_runs = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return document_runs(docs, settings).withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(all_runs.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
