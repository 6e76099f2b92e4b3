"""Mixing sources to target weights by Poisson replication.

A source's documents repeat on average ``rate = copies * weight / documents``
times.  Each document draws its own count from a Poisson distribution with
that mean, by inverting the distribution at a number hashed from its id and
the seed, so a retry or another partitioning gives the same counts.  The document is
exploded by its count, and the copies are put in a global order by a
hash of id and copy number.

A source with a third of all rows costs nothing extra: counts are combined
before the shuffle, and the small table of rates is joined on (source, salt), so a
source's rows are spread over ``salts`` keys.

Defined results: a null source is a source of its own; a weight of zero, or a
source the given weights do not name, gives no copies; documents with a null id
draw from the empty string; repeated rows repeat their draws; an empty table
gives an empty result; null and empty texts count as documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 16.0  # larger means are sums of independent Poisson numbers with at most this mean
TERMS = 90  # terms of a chunk's distribution: the rest is below 1e-30


@dataclass(frozen=True)
class Settings:
    weights: dict[str, float] | None = None  # relative target weight of each source
    temperature: float = 0.5  # without weights: a source weighs documents ** temperature
    epochs: float = 1.0  # expected copies of all documents together, as a multiple of the documents
    seed: int = 5
    salts: int = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts as text, 52 bits."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def distribution(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson mean of at most CHUNK, as far as the sums still grow."""
    first = F.exp(-rate)
    zero = F.struct(first.alias("p"), F.array(first).alias("sums"))

    def step(acc, k):
        p = acc["p"] * rate / k
        below = F.element_at(acc["sums"], -1)
        return F.struct(p.alias("p"), F.when(below + p > below, F.concat(acc["sums"], F.array(below + p))).otherwise(acc["sums"]).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), zero, step, lambda acc: acc["sums"])


def invert(sums: Column, u: Column) -> Column:
    """Smallest k with P(X <= k) > u."""
    return F.size(F.filter(sums, lambda x: x <= u))


def rates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(source, n, rate) of each source."""
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if settings.weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(settings.temperature))
    else:
        weight = F.lit(0.0)
        for name, w in sorted(settings.weights.items()):
            weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("n").alias("all_n"))  # one row
    sizes = sizes.join(F.broadcast(total))
    rate = F.when(F.col("all_weight") > 0, F.lit(settings.epochs) * F.col("all_n") * F.col("weight") / F.col("all_weight") / F.col("n")).otherwise(F.lit(0.0))
    return sizes.select("source", "n", rate.alias("rate"))


def replicate(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs``' columns, ``__copy`` (from 1) and ``__order`` (hash of the global order), one row per copy."""
    s = settings
    chunks = F.greatest(F.ceil(F.col("rate") / CHUNK), F.lit(1)).cast("int")
    of_source = rates(docs, s).withColumn("__chunks", chunks).withColumn("__sums", distribution(F.col("rate") / F.col("__chunks")))
    salted = of_source.select(F.col("source").alias("__s"), F.col("rate").alias("__rate"), "__chunks", "__sums", F.explode(F.sequence(F.lit(0), F.lit(s.salts - 1))).alias("__salt"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(s.salts)).cast("int")
    joined = docs.withColumn("__salt", salt).join(salted.withColumnRenamed("__salt", "__t"), F.col("source").eqNullSafe(F.col("__s")) & (F.col("__salt") == F.col("__t")))
    one = lambda i: invert(F.col("__sums"), uniform(F.lit(s.seed), F.col("doc_id"), i))
    count = F.aggregate(F.sequence(F.lit(1), F.col("__chunks")), F.lit(0), lambda acc, i: acc + one(i))
    copies = joined.withColumn("__count", F.when(F.col("__rate") > 0, count).otherwise(F.lit(0))).filter("__count > 0")
    copies = copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__count"))))
    order = F.md5(F.concat_ws(":", F.lit(f"order{s.seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("__copy").cast("string")).cast("binary"))
    return copies.withColumn("__order", order).select(*docs.columns, "__copy", "__order")


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The copies in a globally shuffled order, with the columns of ``docs``."""
    return replicate(docs, settings).sort("__order", "doc_id", "__copy").drop("__copy", "__order")


def mixture(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, source, copy and position_key (place in the global order) of every copy."""
    out = replicate(docs.select("doc_id", "source"), settings)
    return out.select("doc_id", "source", F.col("__copy").cast("long").alias("copy"), F.col("__order").alias("position_key")).sort("position_key", "doc_id", "copy")


#: DuckDB: the rows of ``mixture`` with the default settings.
MIXTURE_SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, 1.0::DOUBLE * sum(n) OVER () * pow(n::DOUBLE, 0.5) / sum(pow(n::DOUBLE, 0.5)) OVER () / n AS rate FROM sizes),
parts AS (SELECT source, greatest(ceil(rate / {CHUNK}), 1)::INT AS chunks, rate / greatest(ceil(rate / {CHUNK}), 1) AS r FROM rates),
dist AS (
  SELECT source, r, 0 AS k, exp(-r) AS p, 0.0::DOUBLE AS lo, exp(-r) AS hi FROM parts
  UNION ALL SELECT source, r, k + 1, p * r / (k + 1), hi, hi + p * r / (k + 1) FROM dist WHERE k < {TERMS}),
draws AS (
  SELECT d.doc_id, d.source, i.i,
         ('0x' || substr(md5('5:' || coalesce(d.doc_id::VARCHAR, '') || ':' || i.i::VARCHAR), 1, 13))::BIGINT / pow(2.0::DOUBLE, 52) AS u
  FROM documents d JOIN parts s ON d.source IS NOT DISTINCT FROM s.source, LATERAL (SELECT unnest(range(1, s.chunks + 1)) AS i) i),
counts AS (
  SELECT w.doc_id, w.source, sum(c.k)::BIGINT AS n FROM draws w JOIN dist c
  ON w.source IS NOT DISTINCT FROM c.source AND w.u >= c.lo AND w.u < c.hi GROUP BY w.doc_id, w.source)
SELECT doc_id, source, copy, md5('order5:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR) AS position_key
FROM (SELECT doc_id, source, unnest(range(1, n + 1))::BIGINT AS copy FROM counts WHERE n > 0)
"""
