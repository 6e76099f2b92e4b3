"""Hard negatives by inner product, with a multiway hyperplane tree (GNAT style).

Each split point of a tree node owns the rows nearer to it than to its siblings (a cell bounded by hyperplanes)
and stores, for every sibling's subtree, the least and greatest distance from itself to the rows of that subtree; each
subtree also stores the least and greatest length of its rows.  Points are chosen far apart from one another in a
bounded sample of the rows (``sample``, ``sample_bytes``); all rows go down the tree, and ranges cover all rows.

A query is a window of scores [least, greatest].  Since |q-x|^2 = |q|^2 + |x|^2 - 2 q.x, the window is an annulus of
distances for each subtree.  At a node, a sibling is left out as soon as, for one of the split points, its stored range and the triangle
inequality rule out every distance in the annulus.  Leaves that remain are searched exactly: a leaf's
rows are dealt into blocks and its queries into slices, each pair of which is one matrix product in one task, and gives the first
rows of each window only, so neither a leaf with a third of all rows nor many queries meet in one task.

Positives: a first search in the anchor's own leaf gives a lower bound of the window, the second one covers all
leaves left.  Negatives: each positive's window of scores, likewise raised by a search in the anchor's own leaf.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part.  Equal rows count once;
rows that repeat an id with another label or vector are rows of their own; the smallest of them by label and vector is the anchor, and none
its positive.  Vectors of different lengths are compared as if the shorter one ended in zeros.  An anchor without positives, and a
positive without negatives, gives no rows.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage


@dataclass(frozen=True)
class Settings:
    positives: int = 5  # of an anchor
    negatives: int = 5  # of a positive
    least: int = 80  # a negative's score in hundredths of the positive's, at least
    greatest: int = 100  # and at most
    degree: int = 8  # split points of a node
    leaf: float = 4.0  # mean rows of a leaf, times the square root of all rows: leaves and their rows grow alike
    sample: int = 4096  # rows that split points are chosen from
    sample_bytes: int = 1 << 25
    block: int = 4096  # rows of a leaf that a task compares at once
    slice: int = 1024  # queries that a task compares at once
    seed: int = 13


@dataclass
class Node:
    points: np.ndarray
    children: list  # Node, or the number of a leaf
    number: int = 0
    near: np.ndarray | None = None  # [i, j]: least distance from point i to the rows below child j
    far: np.ndarray | None = None
    short: np.ndarray | None = None  # [j]: least length of the rows below child j
    long: np.ndarray | None = None


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * x @ points.T, 0))


def grow(sample: np.ndarray, depth: int, s: Settings) -> tuple[list[Node], int]:
    """Inner nodes (the root first) and the number of leaves."""
    rng, nodes, leaves = np.random.default_rng(s.seed), [], [0]

    def below(x: np.ndarray, depth: int):
        x = np.unique(x, axis=0) if depth else x
        if not depth or len(x) < 2 * s.degree:
            leaves[0] += 1
            return leaves[0] - 1
        x = x[rng.permutation(len(x))]
        tried = x[: 4 * s.degree]  # far apart: each next point is the one farthest from those chosen
        chosen, gap = [0], _distances(tried, tried[:1])[:, 0]
        while len(chosen) < s.degree:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, _distances(tried, tried[chosen[-1:]])[:, 0])
        node = Node(tried[chosen], [], len(nodes))
        nodes.append(node)
        own = _distances(x, node.points).argmin(axis=1)
        node.children = [below(x[own == j], depth - 1) for j in range(s.degree)]
        return node

    below(sample, depth)
    return nodes, leaves[0]


def _descend(nodes: list[Node], x: np.ndarray):
    """Yields (node, rows, distances, child) for every inner node that rows of x pass; at last the leaves of all rows."""
    leaf = np.zeros(len(x), np.int32)
    todo = [(nodes[0], np.arange(len(x)))] if nodes else []
    while todo:
        node, rows = todo.pop()
        d = _distances(x[rows], node.points)
        own = d.argmin(axis=1)
        yield node, rows, d, own
        for j, child in enumerate(node.children):
            if (sub := rows[own == j]).size:
                if isinstance(child, Node):
                    todo.append((child, sub))
                else:
                    leaf[sub] = child
    yield leaf


def remaining(nodes: list[Node], q: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, queries whose window of scores [least, greatest] may hold a row of the leaf)."""
    length = (q * q).sum(axis=1)
    todo = [(nodes[0], np.arange(len(q)))] if nodes else []
    if not nodes and len(q):
        yield 0, np.arange(len(q))
    while todo:
        node, rows = todo.pop()
        d = _distances(q[rows], node.points)  # [query, i]
        slack = 1e-7 * (1 + length[rows, None] + node.long[None] ** 2)  # of rounding, in squares
        with np.errstate(invalid="ignore"):
            inner = np.sqrt(np.maximum(length[rows, None] + node.short[None] ** 2 - 2 * greatest[rows, None] - slack, 0))
            outer = length[rows, None] + node.long[None] ** 2 - 2 * least[rows, None] + slack
            least_d = np.maximum(d[:, :, None] - node.far[None], node.near[None] - d[:, :, None]).max(axis=1)
            most_d = (d[:, :, None] + node.far[None]).min(axis=1)
            alive = np.isfinite(node.short)[None] & (outer >= 0) & (np.maximum(least_d, 0) ** 2 <= outer + slack) & (most_d**2 + slack >= inner**2)
        for j, child in enumerate(node.children):
            if (sub := rows[alive[:, j]]).size:
                if isinstance(child, Node):
                    todo.append((child, sub))
                else:
                    yield child, sub


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _usable(vectors: DataFrame, dim: int) -> DataFrame:
    x = F.concat("e", F.array_repeat(F.lit(0.0), F.greatest(F.lit(dim) - F.size("e"), F.lit(0))))
    return _finite(vectors).select("vec_id", "label", x.alias("e")).distinct()


def _finite(vectors: DataFrame) -> DataFrame:
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter("vec_id is not null and label is not null and e is not null").filter(fine).withColumn("e", F.transform("e", lambda x: x + 0.0))


def _located(rows: DataFrame, nodes: list[Node], label_type: str) -> DataFrame:
    """(vec_id, label, x, leaf): all rows go down the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                e = part.column(2)
                x = e.flatten().to_numpy().reshape(len(e), -1)
                *_, leaf = _descend(nodes, x)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(leaf)], names=["vec_id", "label", "x", "leaf"])

    return rows.mapInArrow(run, f"vec_id long, label {label_type}, x binary, leaf int")


def _measure(located: DataFrame, nodes: list[Node], s: Settings) -> None:
    """Fills the ranges of all nodes from all rows; a task gives one row per node and pair of children."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n = s.degree, len(nodes)
        near, far = np.full((n, k, k), np.inf), np.full((n, k, k), -np.inf)
        short, long = np.full((n, k), np.inf), np.full((n, k), -np.inf)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                x = _matrix(b.column(0).slice(at, 2048))
                lengths = np.sqrt((x * x).sum(axis=1))
                for step in _descend(nodes, x):
                    if isinstance(step, tuple):
                        node, rows, d, own = step
                        for j in np.unique(own):
                            here, m = d[own == j], node.number
                            near[m, :, j], far[m, :, j] = np.minimum(near[m, :, j], here.min(axis=0)), np.maximum(far[m, :, j], here.max(axis=0))
                            size = lengths[rows[own == j]]
                            short[m, j], long[m, j] = min(short[m, j], size.min()), max(long[m, j], size.max())
        m, i, j = np.nonzero(np.isfinite(near))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (m.astype(np.int32), i.astype(np.int32), j.astype(np.int32), near[m, i, j], far[m, i, j], short[m, j], long[m, j])], names=["m", "i", "j", "near", "far", "short", "long"])

    ranges = located.select("x").mapInArrow(run, "m int, i int, j int, near double, far double, short double, long double")
    ranges = ranges.groupBy("m", "i", "j").agg(F.min("near").alias("near"), F.max("far").alias("far"), F.min("short").alias("short"), F.max("long").alias("long"))
    for node in nodes:
        k = len(node.points)
        node.near, node.far = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        node.short, node.long = np.full(k, np.inf), np.full(k, -np.inf)
    for r in ranges.collect():  # nodes x degree^2, bounded by the sample
        node = nodes[r["m"]]
        node.near[r["i"], r["j"]], node.far[r["i"], r["j"]], node.short[r["j"]], node.long[r["j"]] = r["near"], r["far"], r["short"], r["long"]


_FOUND = "anchor_id long, w int, vec_id long, score double"


class Tree:
    """All rows by leaf and block, with the tree that leads to them."""

    def __init__(self, vectors: DataFrame, settings: Settings = Settings(), stage: Stage | None = None):
        s, self.settings = settings, settings
        self.stage = stage or Stage(vectors.sparkSession, "negatives")
        self.label_type = vectors.schema["label"].dataType.simpleString()
        dim = _finite(vectors).agg(F.max(F.size("e"))).first()[0] or 1
        rows = self.stage.write(_usable(vectors, dim), "rows")
        n = rows.count()
        bound = max(1, min(s.sample, s.sample_bytes // (8 * dim)))
        picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(bound).select("e").toArrow().column(0)
        sample = np.array([v.as_py() for v in picked], np.float64).reshape(len(picked), dim)
        self.nodes, self.leaves = grow(sample, max(0, math.ceil(math.log(max(n, 1) ** 0.5 / s.leaf, s.degree))), s)
        self.rows = self.stage.write(_located(rows, self.nodes, self.label_type), "located", 4096)
        if self.nodes:
            _measure(self.rows, self.nodes, s)
        sizes = self.rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("blocks"))
        self.sizes = self.stage.write(sizes, "sizes")  # one row per leaf, bounded by the sample

    def search(self, queries: DataFrame, first: int, same_label: bool, everywhere: bool) -> DataFrame:
        """(anchor_id, w, vec_id, score, rank): the ``first`` rows of each window, by score, then vec_id.

        ``queries`` have anchor_id, label, x, leaf and windows, an array of (w, least, greatest) in scores.  Rows of the
        same label, or those of different ones.  Without ``everywhere`` only those in the anchor's own leaf.
        """
        s, nodes, label_type = self.settings, self.nodes, self.label_type

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    rows = [(k, w["w"], w["least"], w["greatest"]) for k, ws in enumerate(part.column(4).to_pylist()) for w in ws]
                    if not rows:
                        continue
                    who = np.array([r[0] for r in rows])
                    least, greatest = (np.array([r[c] for r in rows], np.float64) for c in (2, 3))
                    q = _matrix(part.column(2))
                    for leaf, chosen in remaining(nodes, q[who], least, greatest):
                        asked: dict[int, list] = {}
                        for r in chosen:
                            asked.setdefault(int(who[r]), []).append({"w": rows[r][1], "least": rows[r][2], "greatest": rows[r][3]})
                        take = pa.array(list(asked))
                        yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in range(3)), pa.array([leaf] * len(asked), pa.int32()), pa.array(list(asked.values()), _WINDOWS)], names=["anchor_id", "label", "x", "leaf", "windows"])

        chosen = queries.select("anchor_id", "label", "x", "leaf", "windows")
        if everywhere:
            chosen = chosen.mapInArrow(visit, f"anchor_id long, label {label_type}, x binary, leaf int, windows array<struct<w:int,least:double,greatest:double>>")
        visits = self.stage.write(chosen, "visits", 1024)
        slices = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / s.slice).cast("int").alias("slices"))
        shape = F.broadcast(self.sizes.join(slices, "leaf"))  # one row per leaf
        number = lambda id_, n: F.pmod(F.xxhash64(id_), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = self.rows.join(shape, "leaf").select("leaf", number("vec_id", "blocks").alias("block"), every("slices").alias("slice"), "vec_id", "label", "x")
        right = visits.join(shape, "leaf").select("leaf", every("blocks").alias("block"), number("anchor_id", "slices").alias("slice"), "anchor_id", "label", "x", "windows")

        def meet(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(asked):
                return pd.DataFrame([], columns=["anchor_id", "w", "vec_id", "score"]).astype({"anchor_id": "int64", "w": "int32", "vec_id": "int64", "score": "float64"})
            rows = rows.sort_values("vec_id", kind="stable")
            ids, labels, x = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), np.frombuffer(b"".join(rows["x"]), np.float64).reshape(len(rows), -1)
            out = []
            for at in range(0, len(asked), 256):
                part = asked.iloc[at : at + 256]
                scores = np.frombuffer(b"".join(part["x"]), np.float64).reshape(len(part), -1) @ x.T
                for anchor, label, windows, row in zip(part["anchor_id"], part["label"], part["windows"], scores):
                    usable = (labels == label) & (ids != anchor) if same_label else labels != label
                    for w in windows:
                        hit = np.flatnonzero(usable & (row >= w["least"]) & (row <= w["greatest"]))
                        if len(hit) > first:  # the first ones, and all that tie with the last of them
                            hit = hit[row[hit] >= np.partition(row[hit], len(hit) - first)[len(hit) - first]]
                        hit = hit[np.argsort(-row[hit], kind="stable")][:first]
                        out += [(anchor, w["w"], ids[k], row[k]) for k in hit]
            got = pd.DataFrame(out, columns=["anchor_id", "w", "vec_id", "score"])
            return got.astype({"anchor_id": "int64", "w": "int32", "vec_id": "int64", "score": "float64"})

        keys = ["leaf", "block", "slice"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, _FOUND)
        rank = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.col("score").desc(), "vec_id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= first)


_WINDOWS = pa.list_(pa.struct([("w", pa.int32()), ("least", pa.float64()), ("greatest", pa.float64())]))


def _raised(queries: DataFrame, found: DataFrame, first: int) -> DataFrame:
    """The queries' windows, raised to the last of ``first`` rows found where there are so many."""
    known = found.filter(F.col("rank") == first).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("known"))
    raised = F.transform("windows", lambda w: F.struct(w["w"].alias("w"), F.greatest(w["least"], F.try_element_at("known", w["w"])).alias("least"), w["greatest"].alias("greatest")))
    return queries.join(known, "anchor_id", "left").withColumn("windows", F.when(F.col("known").isNull(), F.col("windows")).otherwise(raised)).drop("known")


def hard_negatives(vectors: DataFrame, anchors: str, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores (double) for the anchors, the rows of
    ``vectors`` (vec_id, label, embedding) that meet the SQL condition ``anchors`` on vec_id and label.

    Positives are the first ``positives`` rows of the anchor's label by score, then vec_id; a positive's negatives are the first
    rows of other labels whose score times 100 is from ``least`` to ``greatest`` times the positive's score.
    """
    s = settings
    tree = Tree(vectors, s, stage)
    write = tree.stage.write
    window = lambda w, least, greatest: F.struct(F.lit(w).alias("w") if isinstance(w, int) else w.alias("w"), least.cast("double").alias("least"), greatest.cast("double").alias("greatest"))
    own = tree.rows.filter(anchors).groupBy(F.col("vec_id").alias("anchor_id")).agg(F.min(F.struct("label", "x", "leaf")).alias("r")).select("anchor_id", "r.*")
    asked = write(own.withColumn("windows", F.array(window(0, F.lit(float("-inf")), F.lit(float("inf"))))), "anchors")
    near = tree.search(asked, s.positives, True, False)
    positives = write(tree.search(_raised(asked, near, s.positives), s.positives, True, True), "positives")
    # exact for integer scores: the least multiple that passes is compared, not a rounded quotient
    bound = lambda hundredths: F.col("score") * hundredths / 100
    windows = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window(F.col("rank"), bound(s.least), bound(s.greatest)))).alias("windows"))
    asked = write(asked.drop("windows").join(windows, "anchor_id"), "windows")
    near = tree.search(asked, s.negatives, False, False)
    negatives = tree.search(_raised(asked, near, s.negatives), s.negatives, False, True)
    of = positives.select("anchor_id", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(of, ["anchor_id", "w"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding): labels of every seventh id go up by one, components become floor(256 * x)."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(F.abs(x) < float("inf"), F.floor(x * 256).cast("double")))
    return vectors.select("vec_id", label.alias("label"), whole.alias("embedding"))


def mined(vectors: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """Hard negatives of every hundredth id, scores as whole numbers."""
    found = hard_negatives(vectors, "vec_id % 100 = 0", settings, stage)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("positive_score").cast("long").alias("positive_score"), F.col("negative_score").cast("long").alias("negative_score"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""
