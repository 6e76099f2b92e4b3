"""Near-duplicate vectors by sorted projection passes.

Each pass gives every vector a key, the signs of its projections on random directions,
concatenated to one number, and orders the vectors of one length lexicographically by it.  In that order
a vector is compared in double precision with its neighbours in a window: the ``window`` rows before it, and
beyond them all rows before it that agree with it in the ``bits`` leading signs (a run).  The order is dealt
to tasks by ranges that end between runs, and each task streams through its ranges with
the rows of one window in memory.  A run of more than ``block`` rows is cut into blocks, and every block
meets every block, spread over tasks.  Verified pairs of all passes are united to components.

Finding probability: a pair at the threshold (cosine 0.9) agrees in a sign with
probability 0.856 whatever the other vectors are, so it shares a run of ``bits`` signs with
0.856 ** bits.  The number of passes is derived from the bits so that such a pair is missed
in all passes with a probability of at most ``miss``, at every table size and inside
hot groups; closer pairs are missed less often, and what a window finds beyond the runs comes on top.
The bits are those with the least work by the counted run lengths of one pass.

A last step counts the direct links inside each component exactly, block of members
against block of members.  Blocks of one component are spread over tasks, and a task
returns one count per member, never a list of pairs.

Equal vectors are one class throughout: their number enters the counts.

Defined results: vectors that are null, zero, or hold a null or a non-finite component link with
nothing and are kept.  Vectors link with those of their own length only, and each length is compared among its own.
Rows with a null id link with nothing and have a null component.  Rows that
repeat an id count as one vector each towards others' links.  Labels and other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage
from .components import components


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    miss: float = 1e-4  # probability that a pair at the threshold meets in no pass
    window: int = 128  # neighbours before a row that it is compared with, whatever their signs
    finer: int = 8  # signs of a key beyond those of its run; they order the rows inside it
    block: int = 1024  # rows of a block of a long run
    seed: int = 2


def _directions(dim: int, count: int, s: Settings) -> np.ndarray:
    """(count, dim) random directions, the same in every task; a larger count begins with the smaller one's."""
    return np.random.default_rng([s.seed, dim]).standard_normal((count, dim))


def passes(bits: int, s: Settings) -> int:
    """Passes after which a pair at the threshold was in one run with a probability of 1 - ``miss``."""
    together = (1 - math.acos(s.threshold) / math.pi) ** bits
    return 1 if together >= 1 else math.ceil(math.log(s.miss) / math.log1p(-together))


def _raw(x: np.ndarray) -> list[bytes]:
    """Bytes of each row, in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return [v.tobytes() if same else w.tobytes() for v, w, same in zip(short, x, (short == x).all(axis=1))]


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.array([np.frombuffer(v, np.float32 if len(v) == 4 * dim else np.float64) for v in raw], np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _classes(vectors: DataFrame, stage: Stage) -> DataFrame:
    """(node, copies, x, vec): equal usable vectors; node is the smallest id, x the components as doubles."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).filter("vec_id is not null and e is not null and size(e) > 0")
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    v = v.filter(fine)
    return stage.write(v.groupBy("e").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")


def _keyed(classes: DataFrame, n_passes: int, bits: int, s: Settings, vectors: bool = True) -> DataFrame:
    """(pass, dim, key, node, x) of every class and pass; x is null without ``vectors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = {}
        shifts = np.arange(bits, dtype=np.int64)[::-1]
        for b in batches:
            sizes = pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
            for dim, at in ((int(d), at) for d in np.unique(sizes) for at in range(0, int((sizes == d).sum()), 1024)):
                if dim not in directions:
                    directions = {dim: _directions(dim, n_passes * bits, s)}  # those of one length at a time
                part = b.take(pa.array(np.flatnonzero(sizes == dim)[at : at + 1024]))
                x = np.array(part.column(1).to_pylist(), np.float64)
                raw = pa.array(_raw(x) if vectors else [None] * len(x), pa.binary())
                with np.errstate(over="ignore", invalid="ignore"):
                    peak = np.abs(x).max(axis=1, keepdims=True)
                    signs = (x / peak) @ directions[dim].T >= 0
                for p in range(n_passes):
                    key = (signs[:, p * bits : (p + 1) * bits].astype(np.int64) << shifts).sum(axis=1, dtype=np.int64)
                    same = [pa.array(np.full(len(x), v, np.int32)) for v in (p, dim)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(key), part.column(0), raw], names=["pass", "dim", "key", "node", "x"])

    return classes.select("node", "e").mapInArrow(run, "pass int, dim int, key long, node long, x binary")


def _bits(classes: DataFrame, n: int, s: Settings) -> int:
    """Number of leading signs with the least work: copies of rows that are dealt, and comparisons by the run lengths of one pass."""
    usual = max(math.ceil(math.log2(max(n, 1) / s.block)), 0)
    tried, most = list(range(max(usual - 3, 1), usual + 9)), usual + 8
    keys = _keyed(classes, 1, most, s, vectors=False).select("dim", "key", F.explode(F.array(*[F.lit(x) for x in tried])).alias("bits"))
    runs = keys.groupBy("bits", "dim", F.expr(f"shiftright(key, {most} - bits)").alias("run")).agg(F.count(F.lit(1)).alias("size"))
    pairs = {r["bits"]: r["pairs"] for r in runs.groupBy("bits").agg(F.sum(F.col("size").cast("double") * F.col("size")).alias("pairs")).collect()}  # one row per number of bits
    # to deal a row out costs as much as some thousand comparisons
    return min(tried, key=lambda x: passes(x, s) * ((1000.0 + s.window) * n + pairs.get(x, 0) * (1 + 1000 / s.block)))


def _forest(near: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links ``near`` between the rows ``lo`` and the columns ``hi``."""
    out, rows, cols = [], near.any(axis=1), np.ones(near.shape[1], bool)
    for start in np.flatnonzero(rows):
        if not rows[start]:
            continue
        rows[start], front = False, [start]
        while front:
            i = front.pop()
            new = np.flatnonzero(near[i] & cols)
            cols[new] = False
            out += [(lo[i], hi[j]) for j in new]
            for j in new:
                if rows.any() and len(back := np.flatnonzero(near[:, j] & rows)):
                    rows[back] = False
                    out += [(lo[k], hi[j]) for k in back]
                    front += back.tolist()
    return out


def _window_links(ordered: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) of sorted rows (pass, dim, run, node, x) with the rows of their windows, as a forest per stretch of ``window`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, None  # pass and length of the rows before, and those of them that the window still holds
        for b in batches:
            number, dims, runs, nodes = (b.column(k).to_numpy() for k in range(4))
            change = np.flatnonzero((np.diff(number) != 0) | (np.diff(dims) != 0)) + 1
            for start, end in zip(np.r_[0, change], np.r_[change, b.num_rows]):
                for at in range(start, end, s.window):
                    part = slice(at, min(at + s.window, end))
                    u = _unit(b.column(4).slice(at, part.stop - at).to_pylist(), int(dims[at]))
                    if last != (last := (number[at], dims[at])):
                        before = (np.zeros(0, np.int64), np.zeros(0, np.int64), u[:0])
                    r, node, v = (np.concatenate(x) for x in zip(before, (runs[part], nodes[part], u)))
                    near = u @ v.T >= s.threshold
                    np.fill_diagonal(near[:, len(before[0]) :], False)
                    found = np.array(_forest(near, nodes[part], node), np.int64).reshape(-1, 2)
                    if len(found):
                        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
                    keep = max(min(len(r) - s.window, int(np.searchsorted(r, r[-1]))), 0)
                    before = (r[keep:], node[keep:], v[keep:])

    return ordered.select("pass", "dim", "run", "node", "x").mapInArrow(run, "a long, b long")


def _block_links(rows: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) inside long runs, as a forest per pair of blocks of rows (pass, dim, run, size, node, x)."""
    dealt = rows.withColumn("n", F.ceil(F.col("size") / s.block).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))  # each block meets every block once
    met = met.select("pass", "dim", "run", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "x")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        u, node = _unit(pdf["x"].tolist(), int(pdf["dim"].iloc[0])), pdf["node"].to_numpy()
        is_lo, same = (pdf["own"] == pdf["lo"]).to_numpy(), pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
        is_hi = is_lo if same else ~is_lo
        near = u[is_lo] @ u[is_hi].T >= s.threshold
        if same:
            np.fill_diagonal(near, False)
        return pd.DataFrame(_forest(near, node[is_lo], node[is_hi]), columns=["a", "b"]).astype("int64")

    return met.groupBy("pass", "dim", "run", "lo", "hi").applyInPandas(links, "a long, b long")


def _pass_links(keyed: DataFrame, s: Settings, stage: Stage) -> DataFrame:
    """Links (a, b) that the windows of all passes find; ``keyed`` has the keys without their ``finer`` signs in ``run``."""
    run = ["pass", "dim", "run"]
    sizes = stage.write(keyed.groupBy(*run).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > s.block), "long-runs")
    ordered = keyed.join(sizes, run, "left_anti").repartitionByRange(*run).sortWithinPartitions("pass", "dim", "key", "node")
    return _window_links(ordered, s).unionByName(_block_links(keyed.join(sizes, run), s))


def _direct_links(members: DataFrame, s: Settings, stage: Stage) -> DataFrame:
    """(node, links): for each member (component, node, copies, e) the vectors linked directly with it, all copies counted."""
    size = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    small = 512  # rows of a block of members
    dealt = members.join(stage.write(size, "component-sizes"), "component").withColumn("n", F.ceil(F.col("size") / small).cast("int"))
    dealt = stage.write(dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int")), "dealt")
    # each block meets every block of its component once: as the lower and as the upper one of a pair
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    met = dealt.withColumn("other", other).select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "copies", "e")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf["e"].tolist(), np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        copies, lo = pdf["copies"].to_numpy(), (pdf["own"] == pdf["lo"]).to_numpy()
        hi = ~lo if (pdf["lo"].iloc[0] != pdf["hi"].iloc[0]) else lo
        out = np.zeros(len(x), np.int64)
        near = x[lo] @ x[hi].T >= s.threshold
        if lo is hi:
            np.fill_diagonal(near, True)  # equal vectors link whatever rounding does to their cosine
            out += near @ copies - 1
        else:
            out[lo], out[hi] = near @ copies[hi], copies[lo] @ near
        return pd.DataFrame({"node": pdf["node"], "links": out})

    return met.groupBy("component", "lo", "hi").applyInPandas(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    s, stage = settings, stage or Stage(vectors.sparkSession, "vectors")
    classes = _classes(vectors, stage)
    n = classes.count()
    bits = _bits(classes, n, s)
    # keys are written: the run lengths, the bounds of the ranges and the rows come from the same table
    keyed = _keyed(classes, passes(bits, s), bits + s.finer, s).withColumn("run", F.shiftright("key", s.finer))
    # each link is written once, after the shuffle that unites the passes: a task of a pass has few of them, and a file each costs more than they do
    comp = components(_pass_links(stage.write(keyed, "keyed"), s, stage), stage)
    comp = stage.write(comp, "components")
    linked = _direct_links(classes.join(comp, "node"), s, stage)
    known = classes.join(comp, "node", "left").join(linked, "node", "left").filter("copies > 1 or component is not null")
    known = stage.write(known.select("e", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.col("copies") - 1).alias("links")), "known")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    usable = rows.join(known, "e", "left").withColumn("links", F.when(F.col("vec_id").isNotNull(), F.col("links")))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return usable.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
