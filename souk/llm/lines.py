"""Lines that many documents hold, dropped by a sorted stream over hashed lines.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased.  Keys of at
least ``least_chars`` code points that stand in ``least_docs`` documents or more lose all their
lines, except in the document with the largest id, which comes first in the order of the stream.

1. Every such line becomes a record (128-bit hash of the key, doc_id, row, position), which is written.
2. Records are range-partitioned by (hash, doc_id descending, row, position) and sorted in the same order, so a
   line that stands in a third of all documents covers many ranges.
3. Each task streams its range once.  Of a key that begins and ends in the range it passes over
   the first document's records, holds back the second's, and gives out all but the first's once a third
   document comes.  A key at an end of the range may go on in the next one: its pieces are counted, two rows
   per range at most, and records that a piece cannot decide are decided after the counts are joined.
4. The places of dropped lines become one compressed bitmap per document row (bit set: line
   stays).  Texts are touched again only to apply it.

Defined results: a null or empty text is one empty line, which stays.  Rows with a null id keep all
lines and count for no key.  Rows that repeat an id are one document; each of its texts has a bitmap of
its own.  Other columns pass through ``without_repeated_lines`` untouched, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage

_DROP, _OPEN, _PIECE = 0, 1, 2  # kinds of rows that the stream gives out
_RECORD = "h1 long, h2 long, doc_id long, row long, pos int"
_STREAM = "kind int, " + _RECORD + ", n_docs long, least long"


@dataclass(frozen=True)
class Settings:
    least_chars: int = 20
    least_docs: int = 3


def line_keys(text: bytes, least_chars: int) -> tuple[list[int], list[bytes]]:
    """Positions and keys of the lines whose key is long enough."""
    pos, keys = [], []
    for i, line in enumerate(text.lower().split(b"\n")):  # bytes: only A-Z and ASCII white space change
        if len(line) >= least_chars:
            line = line.strip()
            if len(line) >= least_chars and (line.isascii() or len(line.decode("utf-8", "replace")) >= least_chars):
                pos.append(i)
                keys.append(line)
    return pos, keys


def _records(docs: DataFrame, s: Settings) -> DataFrame:
    chosen = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sizes, places, digests = [], [], []
                for text in part.column(2):
                    pos, keys = line_keys(text.as_buffer().to_pybytes(), s.least_chars) if text.is_valid else ([], [])
                    sizes.append(len(pos))
                    places += pos
                    digests += map(xxhash.xxh3_128_digest, keys)
                h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                own = [np.repeat(part.column(k).to_numpy(), sizes) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])), *map(pa.array, own), pa.array(places, pa.int32())], names=["h1", "h2", "doc_id", "row", "pos"])

    return chosen.mapInArrow(run, _RECORD)


@dataclass
class _Run:
    """The run of one key that is open at the end of a batch."""

    key: tuple[int, int]
    first: bool  # the range's first run: it may have begun in the range before
    greatest: int
    docs: int = 0
    last: int = 0
    held: list = field(default_factory=list)  # records of the second document


def stream(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """Dropped records, undecided records and the counted pieces of keys at the ends, of one sorted range."""
    run: _Run | None = None

    def rows(kind: int, part: list) -> pa.RecordBatch:
        n = len(part[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *map(pa.array, part), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=_NAMES)

    def piece(r: _Run) -> pa.RecordBatch:
        one = [_PIECE, *r.key, r.greatest, None, None, r.docs, r.last]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(one, _TYPES)], names=_NAMES)

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in range(5)]
        h1, h2, doc = cols[:3]
        goes_on = run is not None and run.key == (h1[0], h2[0])
        new_key = np.r_[not goes_on, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        new_doc = np.r_[not goes_on or doc[0] != run.last, doc[1:] != doc[:-1]] | new_key
        at, nth, starts = np.cumsum(new_key), np.cumsum(new_doc), np.flatnonzero(new_key)
        nth -= np.r_[-run.docs if goes_on else 0, nth[starts] - 1][at]  # which document of its key, from 1
        docs = np.zeros(at[-1] + 1, np.int64)
        docs[at] = nth  # the last of a run stays
        full = docs >= least_docs
        if run is not None and (at[-1] > 0 or not goes_on):  # the open run ends in this batch or before it
            if goes_on:
                run.docs, run.last = int(docs[0]), int(doc[np.searchsorted(at, 1) - 1])
            if run.first:
                yield piece(run)
            elif run.docs >= least_docs and run.held:
                yield from (rows(_DROP, x) for x in run.held)
        whole = (at > 0) | (goes_on and not run.first)  # not of the range's first run
        if run is None:  # the first run begins with the first record of the range
            whole = at > 1
        dropped, undecided = whole & (nth > 1) & full[at], ~whole
        for kind, chosen in ((_DROP, dropped), (_OPEN, undecided)):
            if chosen.any():
                yield rows(kind, [c[chosen] for c in cols])
        if run is None and at[-1] > 1:
            end = np.searchsorted(at, 2) - 1
            yield piece(_Run((int(h1[0]), int(h2[0])), True, int(doc[0]), int(docs[1]), int(doc[end])))
        if at[-1] > 0:
            k = starts[-1]
            run = _Run((int(h1[k]), int(h2[k])), run is None and at[-1] == 1, int(doc[k]))
        run.docs, run.last = int(docs[-1]), int(doc[-1])
        if run.first:
            continue
        if run.docs >= least_docs:
            yield from (rows(_DROP, x) for x in run.held)
            run.held = []
        elif (second := (at == at[-1]) & (nth > 1)).any():
            run.held.append([c[second] for c in cols])
    if run is not None:
        yield piece(run)
        yield from (rows(_OPEN, x) for x in run.held)


_NAMES = ["kind", "h1", "h2", "doc_id", "row", "pos", "n_docs", "least"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _whole_keys(pieces: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, greatest) of keys that stand at an end of a range; a document in two pieces is one."""
    of_key = pieces.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct(F.col("doc_id").alias("greatest"), "least", "n_docs")), asc=False).alias("p"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("least"))
    again = lambda acc, x: F.when(acc["least"] == x["greatest"], 1).otherwise(0)
    total = F.aggregate("p", zero, lambda acc, x: F.struct((acc["n"] + x["n_docs"] - again(acc, x)).alias("n"), x["least"].alias("least")), lambda acc: acc["n"])
    return of_key.select("h1", "h2", total.alias("all_docs"), F.col("p")[0]["greatest"].alias("greatest"))


def pack(dropped: np.ndarray) -> bytes:
    """Compressed bits, one per line up to the last dropped one, set where the line stays; lines beyond stay."""
    bits = np.ones(-(-(int(dropped.max()) + 1) // 8) * 8, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def unpack(keep: bytes | None, n_lines: int) -> np.ndarray:
    """One boolean per line: it stays."""
    out = np.ones(n_lines, bool)
    if keep is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n_lines]
        out[: len(bits)] = bits
    return out


@F.pandas_udf(T.BinaryType())
def _pack(places: pd.Series) -> pd.Series:
    return places.map(lambda x: pack(np.asarray(x)))


@F.pandas_udf(T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("text", T.StringType())]))
def _apply(text: pd.Series, keep: pd.Series) -> pd.DataFrame:
    out = []
    for t, k in zip(text, keep):
        lines = (t or "").split("\n")
        stays = unpack(k, len(lines)) if k is not None else None
        out.append((len(lines), 0, t or "") if stays is None else (len(lines), int((~stays).sum()), "\n".join([x for x, s in zip(lines, stays) if s])))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])


def keep_bitmaps(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """(doc_id, row, keep) of the rows of ``docs`` that lose lines; row is xxhash64 of the text, keep the bitmap (see ``unpack``)."""
    s, stage = settings, stage or Stage(docs.sparkSession, "lines")
    records = stage.write(_records(docs, s), "records", 2048)
    order = ["h1", "h2", F.col("doc_id").desc(), "row", "pos"]
    sorted_ = records.repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = stage.write(sorted_.mapInArrow(lambda batches: stream(batches, s.least_docs), _STREAM), "streamed")
    keys = _whole_keys(streamed.filter(F.col("kind") == _PIECE)).filter(F.col("all_docs") >= s.least_docs)
    undecided = streamed.filter(F.col("kind") == _OPEN).join(F.broadcast(keys), ["h1", "h2"])  # two keys per range at most
    dropped = streamed.filter(F.col("kind") == _DROP).select("doc_id", "row", "pos")
    dropped = dropped.union(undecided.filter("doc_id < greatest").select("doc_id", "row", "pos"))
    return dropped.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("places")).select("doc_id", "row", _pack("places").alias("keep"))


def _applied(docs: DataFrame, s: Settings, stage: Stage) -> tuple[DataFrame, Column]:
    """``docs`` as a struct column ``given``, and a struct (n_lines, n_dropped, text)."""
    bitmaps = keep_bitmaps(docs, s, stage).select(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row"), "keep")
    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("given"))
    joined = given.join(bitmaps, (F.col("given.doc_id").cast("long") == F.col("of_doc")) & (F.xxhash64("given.text") == F.col("of_row")), "left")
    return joined, _apply(F.col("given.text"), F.col("keep"))


def without_repeated_lines(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``; a null text stays null."""
    joined, applied = _applied(docs, settings, stage or Stage(docs.sparkSession, "lines"))
    text = F.when(F.col("keep").isNull(), F.col("given.text")).otherwise(applied["text"])
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"given.`{c}`") for c in docs.columns])


def line_digests(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text, of every row of ``docs``."""
    joined, applied = _applied(docs.select("doc_id", "text"), settings, stage or Stage(docs.sparkSession, "lines"))
    got = joined.select(F.col("given.doc_id").alias("doc_id"), applied.alias("got"))
    return got.select("doc_id", "got.n_lines", "got.n_dropped", F.sha2(F.col("got.text").cast("binary"), 256).alias("kept_sha256"))


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, row_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM (SELECT doc_id, text, row_number() OVER () AS row_id FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(k.doc_id <> c.holder, false) AS dropped FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY row_id
"""
