"""Exact Jaccard self-join of documents on word shingles, by universe partitioning.

Two sets with 100 * intersection >= 80 * union differ in at most
``(|R| + |S|) // 9`` elements.  Sets fall into size bands.  A band's scheme
hashes the universe of shingles into segments; a set is indexed by the subset that falls
into each segment that is not empty, in its own band's scheme and, where a smaller
partner can lie in the band below, in that one too.  If a set has more
usable segments than a partner can differ in, at least one of them is equal in both
(pigeonhole), so the pair shares an index key.

Cost-based allocation decides what each set relies on:

1. Keys held by at most ``small`` sets are cheap: pairs become
   candidates if the cheap keys that they share, and the frequent ones that they may share, are as many
   as a link leaves equal (a partner spoils at most one segment with each differing element).  More frequent keys are left out (value 0).
2. Sets that then lack usable segments also index the one-deletion
   neighbourhoods of their cheap segments: such a segment still detects a partner that
   differs in one element there, so it counts twice.  This step is exact
   among the sets that lack segments; any other partner has enough of its own.
3. Sets that still lack some are, mostly, parts of large groups.  They are indexed by their
   rarest shingles (as many as a partner can miss, plus one) and size band.  Rare ones give
   pairs at once.  For frequent ones each member's difference from a leader of the group is measured, for a few
   rounds; sets that are still in different components then only meet those whose differences from the leaders
   are close enough for a link (differences are a metric).  Nothing is capped or dropped.

Since components are asked for, pairs already connected need not meet: sets with frequent segment keys are first
compared with a leader each (``_stars``), and cheap keys then only pair sets of different components.
Sets of one task that share a key of step 2 travel as one row, so that a group of near copies makes rows for what differs in it.

Candidates first meet as parity bitmaps: bits in which two bitmaps differ are
at most as many as the elements in which the sets differ, so a pair with more of
them than ``(|R| + |S|) // 9`` cannot be a link.  What remains is
verified on the two whole sets.  Sets are compared as 64-bit shingle hashes; classes of equal sets by
128-bit digests.

Copies of a set are one class throughout, and inside a task only the
first copy writes index keys, so a huge group of copies costs as many keys as there are tasks.

Defined results: a null or empty text, or one of white space only, has an empty
set, no link and itself as component.  Fewer than five words: the whole
sequence is the one shingle.  A row whose id is null gets its count and a null component and
links with nothing.  Rows that repeat an id are judged each by its own text.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, WordHasher, ascii_words, mix64, odd_constants
from .components import components, components_of, ordered

WORDS = 5
SMALL = 32  # an index key of at most so many sets pairs them all
LEADER_ROUNDS = 2  # rounds with one leader per large group, before rings around the leaders decide who meets
TEXTS = 500  # whole texts that a Python worker gets at once
LISTS = 2_000  # lists of keys, or of shingles, that a Python worker gets at once
REMEMBERED = 200_000  # sets that a task knows as written already; more are only written again
BROADCAST_IDS = 1_000_000  # rows of at most three longs; 24 MB
BROADCAST_SETS = 6_000_000  # bytes of whole sets, bitmaps or numbers of sets that are sent to all tasks
PACK = 1_000_000  # keys that a task sorts at once to put the sets of a key in one row
MEMBERS = 256  # sets in such a row at most
_HASHER = WordHasher(100_000)
_C = odd_constants(2 * WORDS + 2, 7)
_DIGEST = odd_constants(2, 70)


def forget_words() -> None:
    """Empties the hasher of this process when a task ends: its worker lives on and would keep the memory."""
    _HASHER.clear()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    h = _HASHER.array(ascii_words(text))
    if not len(h):
        return h
    with np.errstate(over="ignore"):
        if len(h) < WORDS:
            return mix64(np.array([(h * _C[WORDS : WORDS + len(h)]).sum(dtype=np.uint64) + _C[2 * WORDS] * np.uint64(len(h))]))
        total = h[: len(h) - WORDS + 1] * _C[0]
        for j in range(1, WORDS):
            total = total + h[j : len(h) - WORDS + 1 + j] * _C[j]
    return np.unique(mix64(total))


def digest(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return tuple(int(x) for x in np.array([mix64(s ^ c).sum(dtype=np.uint64) for c in _DIGEST]).view(np.int64))


@lru_cache(maxsize=None)
def bands() -> np.ndarray:
    """Smallest size of each band: 1, 2, 3, 5, 8, 12, ... (each at least 1.5 times the one before)."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 3 // 2)))
    return np.array(out)


def schemes(n: int) -> list[tuple[int, int, int]]:
    """(scheme, segments, needed usable segments) in which a set of n shingles is indexed."""
    b = bands()
    k = int(np.searchsorted(b, n, side="right")) - 1
    out = [(k, int(b[k + 1]) - 1, n // 4 + 1)]
    if k and -(-4 * n // 5) < b[k]:  # a partner may lie in the band below; it has at most b[k] - 1
        out.append((k - 1, int(b[k]) - 1, (n + int(b[k]) - 1) // 9 + 1))
    return [(s, 1 if top < 4 else 32 * top // 100 + 3, need) for s, top, need in out]


def _of_scheme(key: np.ndarray, scheme: int) -> np.ndarray:
    return (key & ~np.uint64(1)) | np.uint64(scheme & 1)


def segment_keys(s: np.ndarray, scheme: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per segment that is not empty: key (its last bit tells a set's two schemes apart), start in s, size, and base (the part of a key that names scheme and segment)."""
    seg = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # s is sorted, so segments are runs
    start = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    size = np.diff(np.r_[start, len(s)])
    with np.errstate(over="ignore"):
        base = (seg[start] * _C[2 * WORDS] + np.uint64(scheme + 1)) * _C[2 * WORDS + 1]
        key = _of_scheme(mix64(np.add.reduceat(mix64(s), start) + base), scheme)
    return key, start, size, base


def deletion_keys(s: np.ndarray, scheme: int, start: np.ndarray, size: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of segments with one element left out (an emptied segment has no key), and the segment of each."""
    own = np.repeat(np.arange(len(start)), size)
    m = mix64(s)
    with np.errstate(over="ignore"):
        left = np.add.reduceat(m, start)[own] - m
        key = _of_scheme(mix64(left + base[own]), scheme)
    many = size[own] > 1
    return key[many], own[many]


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, n, d1, d2, band, spare0, spare1, keys: of each document; keys (binary) only with the first copy of a set in a task.
    ``spare0``, ``spare1``: segments beyond the needed ones in the scheme of even and of odd number, null without it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, out = b.slice(at, 512), []
                for doc_id, text in zip(part.column(0), part.column(2)):
                    s = shingles(text.as_py())
                    d, band, spare, keys = digest(s), None, [None, None], None
                    if len(s) and doc_id.is_valid and d not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(d)
                        each = [(k, segment_keys(s, k, m)[0], need) for k, m, need in schemes(len(s))]
                        band = each[0][0]
                        for k, own, need in each:
                            spare[k & 1] = len(own) - need
                        keys = b"".join(own.tobytes() for _, own, _ in each)
                    out.append((len(s), *d, band, *spare, keys))
                columns = [pa.array([x[k] for x in out], t) for k, t in enumerate((*[pa.int64()] * 6, pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["doc_id", "text_id", "n", "d1", "d2", "band", "spare0", "spare1", "keys"])
        forget_words()

    chosen = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").alias("__text"))
    return chosen.mapInArrow(run, "doc_id long, text_id long, n long, d1 long, d2 long, band long, spare0 long, spare1 long, keys binary")


def _expand(sets: DataFrame) -> DataFrame:
    """(key, set) rows of the stored keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                keys = [np.frombuffer(k, np.int64) for k in part.column(1).to_pylist()]
                own = np.repeat(part.column(0).to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(own)], names=["key", "set"])

    return sets.filter("keys is not null").select("d1", "keys").mapInArrow(run, "key long, set long")


def _runs(keyed: DataFrame, small: int) -> DataFrame:
    """Reads (key, set, c) sorted by key, c a component or null: (0, a, b, even, odd) for each pair of sets in different components
    that share keys of at most ``small`` sets, so many of schemes of even and odd number (a pair may come again with more); (1, key, set) for each row of a more frequent one; without the column c,
    (2, key, set) for each row of a key of two to ``small`` sets instead of pairs.  Rows may also come as (key, members), as
    ``_second`` packs them; a row of a frequent key may then come twice, and only if it is to be told.
    Memory: one batch and one run of ``small`` rows.  Keys are dealt by their own volume, so few rows make few tasks and files."""
    packed = "members" in keyed.columns
    labelled = packed or "c" in keyed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind, a, b, *shared):
            shared = [pa.array(x) for x in shared] or [pa.nulls(len(a), pa.int64())] * 2
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), *shared], names=["kind", "a", "b", "even", "odd"])

        def rows(b):
            if not packed:
                return b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2 if labelled else 1).to_numpy(), np.ones(b.num_rows, bool)
            members = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in b.column(1).to_pylist()]
            own = np.concatenate([np.zeros((0, 3), np.int64), *members])
            return np.repeat(b.column(0).to_numpy(), [len(x) for x in members]), own[:, 0], own[:, 1], own[:, 2] > 0

        def closed(key, own, label, told):
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            few = (size > 1) & (size <= small)
            if labelled:
                pairs = []
                for k in np.unique(size[few]):
                    at = start[size == k][:, None] + np.arange(k)
                    i, j = np.triu_indices(k, 1)
                    x, y = at[:, i].ravel(), at[:, j].ravel()
                    apart = label[x] != label[y]
                    pairs.append(np.stack([own[x[apart]], own[y[apart]], key[x[apart]] & 1], 1))
                if pairs:
                    pairs, shared = np.unique(np.concatenate(pairs), axis=0, return_counts=True)  # rows of a run are sorted by set, so a < b
                    a, b, last = np.ascontiguousarray(pairs.T)
                    yield out(0, a, b, shared * (1 - last), shared * last)
            elif few.any():
                shared = np.repeat(few, size)
                yield out(2, key[shared], own[shared])
            often = np.repeat(size > small, size) & told
            if often.any():
                yield out(1, key[often], own[often])

        key = own = label = np.zeros(0, np.int64)
        told = np.zeros(0, bool)
        hot = None  # (key, last set) of a frequent run that goes on
        for b in batches:
            key, own, label, told = (np.r_[x, y] for x, y in zip((key, own, label, told), rows(b)))
            if packed:
                order = np.lexsort((~told, own, key))
                key, own, label, told = key[order], own[order], label[order], told[order]
            fresh = np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])]
            key, own, label, told = key[fresh], own[fresh], label[fresh], told[fresh]
            if hot is not None:
                n = int(np.searchsorted(key, hot[0], side="right"))
                more = own[:n][(own[:n] != hot[1]) & told[:n]]
                if len(more):
                    yield out(1, np.full(len(more), hot[0]), more)
                    hot = (hot[0], more[-1])
                key, own, label, told = key[n:], own[n:], label[n:], told[n:]
                hot = hot if not len(key) else None
            if len(key):
                last = int(np.searchsorted(key, key[-1]))
                yield from closed(key[:last], own[:last], label[:last], told[:last]) if last else ()
                key, own, label, told = key[last:], own[last:], label[last:], told[last:]
                if len(key) > small:
                    yield out(1, key[told], own[told])
                    hot, key, own, label, told = (key[0], own[-1]), key[:0], own[:0], label[:0], told[:0]
        if len(key):
            yield from closed(key, own, label, told)

    dealt = keyed.repartition("key").sortWithinPartitions(*(["key"] if packed else ["key", "set"]))
    return dealt.mapInArrow(run, "kind int, a long, b long, even long, odd long")


def _labelled(keyed: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, set, c) of (key, set) rows: the set's component so far, itself where it has no link yet."""
    known = comp.withColumnRenamed("node", "set")
    return keyed.join(known, "set", "left").select("key", "set", F.coalesce("component", "set").alias("c"))


def _enough(pairs: DataFrame, allotted: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shared cheap keys, with as many of the frequent ones as both have, can be those of a link: in
    the scheme of the smaller one's band at least ``spare`` + 1 of a set's segments are equal in both."""
    allotted = _light(allotted)
    for x in ("a", "b"):
        pairs = pairs.join(allotted.select(F.col("set").alias(x), *[F.col(c).alias(x + c) for c in allotted.columns if c != "set"]), x)
    enough = [F.col(shared) + F.least(f"aoften{p}", f"boften{p}") > F.greatest(f"aspare{p}", f"bspare{p}") for p, shared in enumerate(("even", "odd"))]
    return pairs.filter(F.when(F.least("aband", "bband") % 2 == 0, enough[0]).otherwise(enough[1])).select("a", "b")


def _allotted(often: DataFrame, sets: DataFrame) -> DataFrame:
    """Of each set that has keys: their number k, its band and spare segments, and of its frequent keys (``often``: key, set) how
    many are of schemes of even and odd number, the smallest x and the greatest y."""
    keys = sets.filter("keys is not null").groupBy(F.col("d1").alias("set")).agg((F.max(F.length("keys")) / 8).cast("long").alias("k"), *[F.max(c).alias(c) for c in ("band", "spare0", "spare1")])
    counts = often.groupBy("set").agg(F.min("key").alias("x"), F.max("key").alias("y"), *[F.count_if(F.pmod("key", F.lit(2)) == v).alias(f"often{v}") for v in (0, 1)])
    return keys.join(counts, "set", "left").select("set", "k", "band", "spare0", "spare1", "x", "y", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("often0", "often1")])


def _stars(allotted: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect large groups: a set with the leaders of two of its frequent segment keys.

    A set goes with the smallest and the greatest of its frequent keys (keys are hashes, so near copies mostly choose the
    same ones): no join of all rows.  The leader is the set with the fewest keys that are not frequent, in large groups of copies the text
    that was changed least.  Sets of which three keys in four or more are not frequent (they only hold a common line) have no leader:
    more differing segments than that leave hardly a link, and what links them all the same is found by their other keys."""
    chosen = allotted.filter("x is not null").withColumn("odd", F.col("k") - F.col("often0") - F.col("often1")).filter("4 * odd < 3 * k")
    top = chosen.select(F.explode(F.array_distinct(F.array("x", "y"))).alias("key"), "set", "odd")
    leader = top.groupBy("key").agg(F.min(F.struct("odd", "set")).alias("l")).select("key", F.col("l.set").alias("leader"))
    pairs = top.join(leader, "key").filter("set <> leader")
    return pairs.select(F.least("set", "leader").alias("a"), F.greatest("set", "leader").alias("b")).distinct()


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the ids (doc_id, d1, d2): sent to all tasks while their counted number is small, else by a shuffle."""
    wanted = ids if ids.count() > BROADCAST_IDS else F.broadcast(ids)
    return docs.select("doc_id", F.col("text").alias("__text")).join(wanted, "doc_id")


def _whole_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, stage: Stage, name: str, whole: bool = True) -> DataFrame:
    """(set, n, bits, s) of each wanted class (set = d1): size, parity bitmap and, if asked for, the whole shingle set."""
    ids = stage.write(classes.join(wanted.select(F.col("set").alias("d1")).distinct(), "d1", "left_semi").select(F.col("rep").alias("doc_id"), "d1", "d2"), f"{name}-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, out = b.slice(at, 512).to_pydict(), []
                for text, d1, d2 in zip(*(part[c] for c in ("__text", "d1", "d2"))):
                    s = shingles(text) if d1 not in seen else None
                    if s is not None and digest(s) == (d1, d2):  # an id may stand on several rows
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(d1)
                        out.append((d1, len(s), bitmap(s), s.tobytes() if whole else None))
                types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=["set", "n", "bits", "s"])
        forget_words()

    return stage.write(_texts_of(docs, ids).mapInArrow(run, "set long, n long, bits binary, s binary"), name, TEXTS)


def bitmap(s: np.ndarray) -> bytes:
    """Parity bitmap of a set: a bit flips with each element that falls on it; between 2 and 4 bits an element."""
    size = max(64, 1 << int(2 * len(s)).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _may_link(n: int, bits: bytes, m: int, other: bytes) -> bool:
    if 4 * max(n, m) > 5 * min(n, m):
        return False
    x, y = (int.from_bytes(v, "little") for v in (bits, other))
    size, least = 8 * max(len(bits), len(other)), 8 * min(len(bits), len(other))
    if len(bits) < len(other):
        x, y = y, x
    while size > least:  # folding halves keeps parities
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (x ^ y).bit_count() <= (n + m) // 9


def _linked(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate([x, y])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= 80 * (len(both) - same)


def _side(sets: DataFrame, key: str, *columns: str) -> DataFrame:
    return sets.select(F.col("set").alias(key), *[F.col(c).alias(key + c) for c in columns])


def _light(sets: DataFrame, *binary: str) -> DataFrame:
    """Written rows of sets, marked to be sent to all tasks while their counted bytes (of longs and of the ``binary`` columns) are few; else joins shuffle them."""
    longs = 8 * (len(sets.columns) - len(binary))
    size = sets.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in binary), F.lit(longs)))).first()[0] or 0
    return F.broadcast(sets) if size <= BROADCAST_SETS else sets


def _near(pairs: DataFrame, sets: DataFrame, stage: Stage) -> DataFrame:
    """The candidate pairs (a, b) of classes whose bitmaps allow a link; written."""

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.to_pydict()
            ok = pa.array([_may_link(*x) for x in zip(p["an"], p["abits"], p["bn"], p["bbits"])], pa.bool_())
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(ok)

    both = pairs.join(_side(sets, "a", "n", "bits"), "a").join(_side(sets, "b", "n", "bits"), "b")
    both = both.select("a", "b", "an", "abits", "bn", "bbits")
    return stage.write(both.mapInArrow(may, "a long, b long").distinct(), "near-pairs", TEXTS)


def _links(near: DataFrame, sets: DataFrame, stage: Stage) -> DataFrame:
    """The links (a, b) among pairs of classes whose whole sets are given; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                p = b.slice(at, 256).to_pydict()
                ok = [(x, y) for x, y, u, v in zip(p["a"], p["b"], p["as"], p["bs"]) if _linked(u, v)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in ok], pa.int64()) for k in (0, 1)], names=["a", "b"])

    both = near.join(_side(sets, "a", "s"), "a").join(_side(sets, "b", "s"), "b")
    return stage.write(both.select("a", "b", "as", "bs").mapInArrow(run, "a long, b long"), "links", TEXTS)


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, stage: Stage, name: str) -> DataFrame:
    """The links (a, b) among candidate pairs of classes: bitmaps first, whole sets of what remains."""
    near = _near(pairs, _light(_whole_sets(docs, classes, _ends(pairs), stage, f"{name}-bitmaps", whole=False), "bits", "s"), stage)
    return _links(near, _light(_whole_sets(docs, classes, _ends(near), stage, f"{name}-sets"), "bits", "s"), stage)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()


def _lacking(n: int, lacks: int) -> list[tuple[int, int, int]]:
    """The schemes of a set of n shingles whose bit (1: even number, 2: odd) is in ``lacks``."""
    return [x for x in schemes(n) if lacks >> (x[0] & 1) & 1]


def _second(short: DataFrame) -> DataFrame:
    """(key, members) of the sets (set, s, c, lacks, frequent) that lack segments: all segments and one-deletion neighbourhoods of the schemes in which they do; members: (set, c, told) of
    the sets of a task that share the key, in rows of at most ``MEMBERS``; ``told``: the segment's own key is not frequent, so it matters whether this one is."""

    def packed(keys: list[np.ndarray], owns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, own = np.concatenate(keys), np.concatenate(owns)
        order = np.argsort(key, kind="stable")
        key, own = key[order], own[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        place = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        start = np.flatnonzero(place % MEMBERS == 0)
        for at in range(0, len(start), 4096):
            lo = start[at : at + 4096]
            hi = np.r_[lo[1:], start[at + 4096] if at + 4096 < len(start) else len(key)]
            members = pa.array([own[x:y].tobytes() for x, y in zip(lo, hi)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(key[lo]), members], names=["key", "members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owns, held = [], [], 0
        for b in batches:
            for own, data, c, lacks, frequent in zip(*(b.column(k).to_pylist() for k in range(5))):
                s, frequent = np.frombuffer(data, np.uint64), np.array(frequent or [], np.int64)
                for scheme, m, _ in _lacking(len(s), lacks):
                    key, start, size, base = segment_keys(s, scheme, m)
                    gone, seg = deletion_keys(s, scheme, start, size, base)
                    told = ~np.isin(key.view(np.int64), frequent)
                    keys.append(np.r_[key, gone].view(np.int64))
                    owns.append(np.full((len(keys[-1]), 3), (own, c, 0)))
                    owns[-1][:, 2] = np.r_[told, told[seg]]
                    held += len(keys[-1])
                if held >= PACK:
                    yield from packed(keys, owns)
                    keys, owns, held = [], [], 0
        if held:
            yield from packed(keys, owns)

    return short.select("set", "s", "c", "lacks", "frequent").mapInArrow(run, "key long, members binary")


def _still_short(short: DataFrame) -> DataFrame:
    """The sets whose segments, valued 0, 1 or 2, do not reach what they need even with deletions; ``often``: keys frequent
    there, ``frequent``: segments that are frequent among all sets (value 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out = []
                for own, data, often, lacks, frequent in zip(*(b.slice(at, 256).column(k).to_pylist() for k in range(5))):
                    s, often = np.frombuffer(data, np.uint64), np.array((often or []) + (frequent or []), np.int64)
                    for scheme, m, need in _lacking(len(s), lacks):
                        key, start, size, base = segment_keys(s, scheme, m)
                        gone, seg = deletion_keys(s, scheme, start, size, base)
                        once = ~np.isin(key.view(np.int64), often)
                        # an emptied segment has no key, and a frequent neighbour is left out: such segments count once
                        twice = once & (size > 1)
                        twice[seg[np.isin(gone.view(np.int64), often)]] = False
                        if once.sum() + twice.sum() < need:
                            out.append((own, data))
                            break
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary()))], names=["set", "s"])

    return short.select("set", "s", "often", "lacks", "frequent").mapInArrow(run, "set long, s binary")


def _prefixes(rest: DataFrame, stage: Stage, small: int) -> tuple[DataFrame, DataFrame]:
    """(key, set): the rarest shingles of each set, as many as a partner can lack plus one, counted over these sets;
    and (set, alone): how many shingles of a set at most ``small`` sets have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                keys = [np.frombuffer(k, np.int64) for k in part.column(1).to_pylist()]
                own = np.repeat(part.column(0).to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(own)], names=["key", "set"])

    tokens = stage.write(rest.select("set", "s").mapInArrow(run, "key long, set long"), "tokens", LISTS)
    counts = stage.write(tokens.groupBy("key").count(), "token-counts")
    each = tokens.join(counts, "key").groupBy("set").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("t"))
    each = stage.write(each.select("set", "t", F.size(F.filter("t", lambda x: x["count"] <= small)).alias("alone")), "ordered")
    n, starts = F.size("t"), F.array(*[F.lit(int(x)).cast("long") for x in bands()])
    band = F.size(F.filter(starts, lambda x: x <= n))
    below = F.ceil(n * 4 / 5) < F.element_at(starts, band)  # a partner may lie in the band below, as in ``schemes``
    of_bands = F.when(below & (band > 1), F.array(band, band - 1)).otherwise(F.array(band))
    # a partner shares at least ceil(0.8 n) shingles, so it lacks at most n - ceil(0.8 n)
    prefix = F.slice("t", 1, (n - F.ceil(n * 4 / 5) + 1).cast("int"))
    rows = each.select("set", F.explode(prefix).alias("shingle"), of_bands.alias("bands"))
    keyed = rows.select("set", "shingle", F.explode("bands").alias("band")).select(F.xxhash64("shingle.key", "band").alias("key"), "set")
    return keyed, each.select("set", "alone")


def _merge(comp: DataFrame, links: DataFrame, stage: Stage) -> DataFrame:
    """Components after more links: those of the links between components, put on the nodes."""
    label = lambda df, c: df.join(comp.select(F.col("node").alias(c), F.col("component").alias("c" + c)), c, "left").withColumn(c, F.coalesce("c" + c, c))
    joined = stage.write(ordered(label(label(links.select("a", "b"), "a"), "b").select("a", "b")), "joined")
    if not joined.take(1):
        return comp
    more = stage.write(components_of(joined, stage), "merged").select(F.col("node").alias("component"), F.col("component").alias("c"))
    moved = comp.join(more, "component", "left").select("node", F.coalesce("c", "component").alias("component"))
    new = more.select(F.col("component").alias("node"), F.col("c").alias("component")).join(comp, "node", "left_anti")
    return stage.write(moved.unionByName(new), "components")


def _distances(pairs: DataFrame, sets: DataFrame, stage: Stage) -> DataFrame:
    """(a, b, d, linked): elements in which the whole sets of each pair differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                p, far, linked = part.to_pydict(), [], []
                for u, v in zip(p["as"], p["bs"]):
                    x, y = np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64)
                    both = np.concatenate([x, y])
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    far.append(len(both) - 2 * same)
                    linked.append(100 * same >= 80 * (len(both) - same))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(2)), pa.array(far, pa.int64()), pa.array(linked, pa.bool_())], names=["a", "b", "d", "linked"])

    both = pairs.join(_side(sets, "a", "s"), "a").join(_side(sets, "b", "s"), "b")
    return stage.write(both.select("a", "b", "as", "bs").mapInArrow(run, "a long, b long, d long, linked boolean"), "distances", TEXTS)


def _large_groups(grouped: DataFrame, alone: DataFrame, sets: DataFrame, comp: DataFrame, stage: Stage) -> DataFrame:
    """Components after comparing inside the groups (key, set) of frequent keys, until all that is connected is found.

    The rarest shingle that two linked sets share is in both prefixes.  If at most ``small`` sets have it, the pair has met already.  So
    of a pair that has not, no shared shingle is that rare: all shingles that few sets have (``alone``) count as differences.
    A set with more of them than a link allows leaves the groups, and two sets meet only if theirs together are within it.
    Groups of the same sets are one.  Each round has one leader per open
    group, the set with the fewest rare shingles (in a group of near copies the least changed text), from the second round on one
    outside the group's largest component, and measures how many elements every member differs from it in.  Differences are a
    metric: two sets whose distances from a leader differ by more than a link allows cannot be linked.  So sets that are still
    apart after the rounds only meet others in a neighbouring ring around the leader."""
    # a partner shares at least 4/5 of a set's shingles
    known = sets.select("set", "n").distinct().join(alone, "set").filter("5 * alone <= n")
    grouped = grouped.join(known.select("set"), "set").select("key", "set")
    of_key = grouped.groupBy("key").agg(F.sum(F.xxhash64("set").cast("decimal(38,0)")).alias("h"), F.count(F.lit(1)).alias("m"))
    one = of_key.groupBy("h", "m").agg(F.min("key").alias("key")).select("key")
    members = stage.write(grouped.join(one, "key").join(known, "set"), "group-members")
    rings = []  # per round: (key, set, d)
    for turn in range(LEADER_ROUNDS + 1):
        state = members.join(comp.withColumnRenamed("node", "set"), "set", "left").select("key", "set", "n", "alone", F.coalesce("component", "set").alias("c"))
        state = stage.write(state, "members")
        parts = state.groupBy("key", "c").count().groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("count", "c")).alias("most"))
        parts = stage.write(parts.filter("parts > 1").select("key", F.col("most.c").alias("top")), "open-groups")
        if not parts.take(1):
            return comp
        state = stage.write(state.join(parts, "key"), "open-members")
        if turn == LEADER_ROUNDS:
            break
        order = F.struct((F.col("c") == F.col("top")) if turn else F.lit(False), "alone", F.xxhash64("set", F.lit(turn)).alias("x"), "set")
        leader = stage.write(state.groupBy("key").agg(F.min(order).alias("l")).select("key", F.col("l.set").alias("b")), "leaders")
        led = state.join(leader, "key").select("key", F.col("set").alias("a"), "b")
        far = _distances(stage.write(led.filter("a <> b").select("a", "b").distinct(), "group-pairs"), sets, stage)
        rings.append(stage.write(led.join(far.select("a", "b", "d").distinct(), ["a", "b"], "left").select("key", F.col("a").alias("set"), F.coalesce("d", F.lit(0)).alias(f"d{turn}")), "rings"))
        comp = _merge(comp, far.filter("linked").select("a", "b"), stage)
    for ring in rings:
        state = state.join(ring, ["key", "set"])
    # the width of a ring: what a link allows between the largest sets of the group, whose sizes differ by a bounded factor
    width = state.groupBy("key").agg((F.floor(F.max("n") * 2 / 9) + 1).alias("width"))
    state = stage.write(state.join(width, "key").withColumn("ring", F.floor(F.col("d0") / F.col("width"))), "ringed")
    names = ["n", "alone", "c", *[f"d{t}" for t in range(len(rings))]]
    few = state.filter("c <> top").select("key", F.explode(F.array(*[F.col("ring") + k for k in (-1, 0, 1)])).alias("ring"), F.col("set").alias("a"), *[F.col(x).alias(f"a{x}") for x in names])
    allowed = F.floor((F.col("n") + F.col("an")) / 9)
    near = (F.col("c") != F.col("ac")) & (4 * F.greatest("n", "an") <= 5 * F.least("n", "an")) & (F.col("alone") + F.col("aalone") <= allowed)
    # d = 2 |x - y| + |y| - |x|, and x - y holds the rare shingles of x
    near = near & (2 * F.col("alone") + F.col("an") - F.col("n") <= allowed) & (2 * F.col("aalone") + F.col("n") - F.col("an") <= allowed)
    for t in range(len(rings)):
        near = near & (F.abs(F.col(f"d{t}") - F.col(f"ad{t}")) <= allowed)
    met = state.join(few, (state["key"] == few["key"]) & (state["ring"] == few["ring"]) & near)
    pairs = met.select(F.least("a", "set").alias("a"), F.greatest("a", "set").alias("b")).distinct()
    return _merge(comp, _links(_near(stage.write(pairs, "group-pairs"), sets, stage), sets, stage), stage)


def similar_documents(docs: DataFrame, stage: Stage | None = None, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``docs``."""
    return _judged(docs, stage or Stage(docs.sparkSession, "jaccard"), small).select("doc_id", "n_shingles", "component_id")


def _judged(docs: DataFrame, stage: Stage, small: int = SMALL) -> DataFrame:
    """doc_id, text_id, n_shingles, component (a number for each group of linked sets) and component_id of every row."""
    sets = stage.write(_sets(docs), "sets", TEXTS)
    classes = stage.write(
        sets.filter("doc_id is not null and n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")),
        "classes",
    )
    found = stage.write(_runs(_expand(sets), small), "first", LISTS)
    # large groups are connected first, so that pairs inside them need not meet
    often = found.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("set"))
    allotted = stage.write(_allotted(often, sets), "allotted")
    stars = stage.write(_stars(allotted), "stars")
    comp = stage.write(components(_links(stars, _light(_whole_sets(docs, classes, _ends(stars), stage, "star-sets"), "bits", "s"), stage), stage), "components")
    cheap = _labelled(found.filter("kind = 2").select(F.col("a").alias("key"), F.col("b").alias("set")), comp)
    pairs = stage.write(_runs(cheap, small).groupBy("a", "b").agg(F.sum("even").alias("even"), F.sum("odd").alias("odd")), "shared-keys")
    pairs = _enough(pairs, allotted.drop("k", "x", "y"))
    # sets with more frequent keys than segments to spare in a scheme: in another one, a partner shares a cheap key
    lacks = F.expr("if(often0 > spare0, 1, 0) + if(often1 > spare1, 2, 0)")
    short = stage.write(allotted.select("set", lacks.alias("lacks")).filter("lacks > 0"), "short")
    groups = short_sets = None
    if short.take(1):
        short_sets = _whole_sets(docs, classes, short, stage, "short-sets")
        labels = comp.withColumnRenamed("node", "set")
        frequent = often.groupBy("set").agg(F.collect_list("key").alias("frequent"))
        lacking = stage.write(short_sets.join(short, "set").join(frequent, "set", "left"), "lacking")
        labelled = lacking.join(labels, "set", "left").select("set", "s", F.coalesce("component", "set").alias("c"), "lacks", "frequent")
        second = stage.write(_runs(_second(labelled), small), "second", LISTS)
        pairs = pairs.unionByName(second.filter("kind = 0").select("a", "b"))
        often = second.filter("kind = 1").groupBy(F.col("b").alias("set")).agg(F.collect_set("a").alias("often"))
        rest = stage.write(_still_short(lacking.join(often, "set", "left")), "rest", LISTS)
        if rest.take(1):
            prefixes, alone = _prefixes(rest, stage, small)
            third = stage.write(_runs(_labelled(prefixes, comp), small), "third")
            pairs = pairs.unionByName(third.filter("kind = 0").select("a", "b"))
            groups = third.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("set"))
    pairs = stage.write(pairs.distinct() if short_sets is not None else pairs, "pairs")
    comp = _merge(comp, _verified(docs, classes, pairs, stage, "candidate"), stage)
    if groups is not None:
        comp = _large_groups(groups, alone, _light(short_sets, "bits", "s"), comp, stage)
    grouped = classes.join(comp.withColumnRenamed("node", "d1"), "d1", "left").select("d1", "d2", "rep", "copies", F.coalesce("component", "d1").alias("component"))
    grouped = stage.write(grouped.filter("copies > 1").unionByName(grouped.filter("copies = 1").join(comp.select(F.col("node").alias("d1")), "d1", "left_semi")), "grouped")
    least = grouped.groupBy("component").agg(F.min("rep").alias("least"))
    special = stage.write(grouped.join(least, "component").select("d1", "d2", "component", "least"), "special")
    out = sets.select("doc_id", "text_id", "n", "d1", "d2").join(special, ["d1", "d2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "text_id", F.col("n").alias("n_shingles"), F.coalesce("component", "d1").alias("component"), own.alias("component_id"))


def keep_one_of_each(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """One document of each group of near copies, with its columns: that with the smallest id.

    Rows whose id is null stay, and so do those without words.  A row is judged by its own set: of rows that repeat an id, one that belongs to
    another document's group goes, one with a text of its own stays, and of rows with the same id and the same set the first by text stays.
    """
    spark = docs.sparkSession
    stage = stage or Stage(spark, "jaccard")
    said = stage.write(_judged(docs, stage).filter("doc_id is not null and n_shingles > 0"), "said")
    # of each group the smallest id stays, and where that stands on several rows of the group, the smallest text hash
    kept = said.filter("doc_id = component_id").groupBy("component", "component_id").agg(F.min("text_id").alias("text_id"), F.count(F.lit(1)).alias("rows"))
    kept = stage.write(kept, "kept")
    gone = said.filter("doc_id <> component_id").select("doc_id", "text_id")
    more = said.filter("doc_id = component_id").join(kept.filter("rows > 1").select("component", F.col("text_id").alias("kept_text")), "component")
    gone = gone.union(more.filter("text_id <> kept_text").select("doc_id", "text_id"))
    gone = stage.write(gone.select(F.col("doc_id").alias("of_doc"), F.col("text_id").alias("of_text")).distinct(), "gone")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("given"))
    match = (F.col("given.doc_id").cast("long") == F.col("of_doc")) & (F.xxhash64("given.text") == F.col("of_text"))
    left = rows.join(gone if gone.count() > BROADCAST_IDS else F.broadcast(gone), match, "left_anti")
    # rows with the same id and text stand several times: one of them stays
    again = stage.write(kept.filter("rows > 1").select("component_id", "text_id"), "repeated")
    columns = [F.col(f"given.`{c}`").alias(c) for c in docs.columns]
    if not again.take(1):
        return left.select(*columns)
    hit = (F.col("given.doc_id").cast("long") == F.col("component_id")) & (F.xxhash64("given.text") == F.col("text_id"))
    several = left.join(again, hit, "left_semi").withColumn("r", F.row_number().over(Window.partitionBy("given.doc_id", F.xxhash64("given.text")).orderBy(F.to_json("given"))))
    return left.join(again, hit, "left_anti").select(*columns).unionByName(several.filter("r = 1").select(*columns))
