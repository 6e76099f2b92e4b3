"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round points nodes at smaller neighbours; after a logarithmic number
of rounds every node points at the smallest node it can reach, which one count per node tells.  Links never
leave the executors; each round's links are written to the shared folder.
Minima are combined before the shuffle; for small link tables, which are counted, they are sent to all tasks, for large ones they are
written before they are joined, so that both sides of that join are plain shuffles whose large keys Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage

WRITE_MINIMA = 1_000_000  # links from which a round's minima are written; the result is the same
BROADCAST_LINKS = 250_000  # links up to which a round's minima (at most two longs for each end of a link) are sent to all tasks


def ordered(links: DataFrame) -> DataFrame:
    """The links (a, b) once each, a > b."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _shape(links: DataFrame) -> tuple[int, bool]:
    """How many links (a, b), a > b, there are, and whether they are stars already: each a points at one b, which points nowhere."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    number, bent = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(F.expr("up > 1 or up = 1 and down = 1"))).first()
    return number, bent == 0


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node reachable."""
    return components_of(stage.write(ordered(links), "links"), stage)


def components_of(now: DataFrame, stage: Stage) -> DataFrame:
    """``components`` of written links as ``ordered`` makes them."""
    number, stars = _shape(now)
    while not stars:
        kept = stage.write if number >= WRITE_MINIMA else (lambda df, name: df)
        sent = F.broadcast if number <= BROADCAST_LINKS else (lambda df: df)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        # a link to the minimum itself stands for its node's link to it; rows that repeat are combined by the small stars
        large = both.join(sent(least), "a").filter("b > a or b = m").select(F.greatest("a", "b").alias("a"), F.col("m").alias("b"))
        large = stage.write(large, "large")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(sent(least), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = stage.write(small.distinct(), "small")
        number, stars = _shape(now)
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
