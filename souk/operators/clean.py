"""Rule-based cleaning with quarantine.

The table is turned ONCE into groups of identical rows (hashes of keys are counted first, and only
rows whose hash repeats are compared whole); each group is tagged with the reason of the
FIRST rule its rows break (or none) and a validity bit - pure functions of
the values, so one grouping serves every rule set.  That yields everything:

* rule rejects   - groups with a reason, re-expanded to one row per raw row;
* exact copies   - valid groups with more than one member;
* distinct rows  - one per valid group, the input of the cleaned table.

Two modes, matching the two cleaning generations:

``flag`` (default)
    keep every distinct valid row; exact-copy groups leave ONE reject row
    ``EXACT_DUPLICATE_ROW (<n-1> extra copies removed)``; rows sharing a key
    get ``duplicate_flag = 1``.
``keep_first``
    every surplus copy is its own ``EXACT_DUPLICATE_ROW`` reject; among the
    distinct rows of one key only the first (total order: remaining columns
    ascending, NULLs first) is kept, the others are rejected
    ``DUPLICATE_<KEY>``.

Rows whose key hash no other row has are decided without a shuffle.  The other
per-key decisions use aggregations (``count``/``min(struct)``) joined back on
the key instead of key-partitioned window sorts, so one key holding a third
of the rows is split by AQE's skew-join handling rather than sorted by one
task.  Every reject row carries ``rejected_row_count`` (raw rows it stands
for) so row accounting stays exact when a group has 3+ copies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class CleanSpec:
    name: str
    key: list[str] = field(default_factory=list)  # NULL-key rule applies to key[0]
    null_reason: str | None = None
    rules: list[tuple[str, str]] = field(default_factory=list)  # (reason, SQL predicate as written)
    valid: str | None = None  # SQL predicate a non-NULL-key row must meet to be kept
    dup_key: list[str] | None = None  # SQL expressions; duplicate_flag / keep-first key
    dup_reason: str | None = None  # keep_first mode: reason for non-first rows of a key
    normalise: dict[str, str] = field(default_factory=dict)  # col -> lower | upper | trim
    flags: list[tuple[str, str]] = field(default_factory=list)  # (name, SQL expr), before duplicate_flag
    duplicate_flag: bool = True
    # keep_first only: exact copies are counted over ALL rows and rules judge
    # only the first copy; the cleaned table is DISTINCT after normalising.
    dedup_all_rows: bool = False
    normalise_before_distinct: bool = False


@dataclass
class CleanResult:
    cleaned: DataFrame
    rejects: DataFrame


def standardize(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """TRIM, then LOWER / UPPER (TRIM strips spaces only, like SQL TRIM)."""
    fns = {"lower": lambda c: F.lower(F.trim(c)), "upper": lambda c: F.upper(F.trim(c)), "trim": F.trim}
    return df.select([fns[rules[c]](F.col(c)).alias(c) if c in rules else F.col(c) for c in df.columns])


def flag_when(predicate: str | Column) -> Column:
    """0/1 flag from a predicate; unknown (NULL) counts as 0."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.when(p, F.lit(1)).otherwise(F.lit(0))


def flag_sequence(ordered_cols: list[str]) -> str:
    """SQL of a flag: 1 when any adjacent pair of the ordered timestamps is out of order (a NULL is in order)."""
    return "CASE WHEN " + " OR ".join(f"{a} > {b}" for a, b in zip(ordered_cols, ordered_cols[1:])) + " THEN 1 ELSE 0 END"


def flag_missing(cols: list[str]) -> str:
    """SQL of a flag: 1 when any of the columns is NULL."""
    return "CASE WHEN " + " OR ".join(f"{c} IS NULL" for c in cols) + " THEN 1 ELSE 0 END"


def _reason_column(spec: CleanSpec) -> Column:
    branches = []
    if spec.key and spec.null_reason:
        branches.append((F.col(spec.key[0]).isNull(), spec.null_reason))
    branches += [(F.expr(p), r) for r, p in spec.rules]
    if not branches:
        return F.lit(None).cast("string")
    out = F.when(branches[0][0], F.lit(branches[0][1]))
    for cond, r in branches[1:]:
        out = out.when(cond, F.lit(r))
    return out


def _valid_column(spec: CleanSpec) -> Column:
    cond = F.lit(True)
    if spec.key and spec.null_reason:
        cond = F.col(spec.key[0]).isNotNull()
    if spec.valid:
        cond = cond & F.expr(spec.valid)
    return F.coalesce(cond, F.lit(False))


def key_hash(key: list[str]) -> Column:
    """64-bit hash of a key given as SQL expressions."""
    return F.xxhash64(*[F.expr(e) for e in key])


ALONE = "_alone"  # column of row groups: no other row has this key


def row_hashes(df: DataFrame, row_hash=None) -> DataFrame:
    """Hashes that more than one row has: 8 bytes a row are shuffled, not the rows."""
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns]) if row_hash is None else row_hash
    return df.select(row_hash.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_hc")).filter("_hc > 1").select("_h")


def row_groups(df: DataFrame, repeated: DataFrame | None = None, row_hash=None, alone: bool = False) -> DataFrame:
    """Groups of identical rows with their size ``_n``.

    Rows whose hash no other row has are groups of their own.  Only rows whose hash repeats are
    compared whole: they are grouped by all columns, combined map-side, so a hot group of copies
    collapses before the shuffle and rows that merely share a hash stay apart.
    ``repeated`` may be the written ``row_hashes(df)``: its size is known then, and where it is small enough for Spark to
    broadcast, rows are not shuffled at all.
    Reasons and validity are pure functions of a row's values, so the same
    groups serve every rule set (both generations) and both outputs.

    ``row_hash`` may be the hash of a key: identical rows share their key, so the answer is the same, and with
    ``alone`` each group says whether its rows are known to share their key with no other row.  One
    count of key hashes then serves the groups and every decision per key.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns]) if row_hash is None else row_hash
    repeated = (repeated if repeated is not None else row_hashes(df, row_hash)).withColumn("_seen", F.lit(True))
    marked = df.withColumn("_h", row_hash).join(repeated, "_h", "left").drop("_h")
    single = marked.filter(F.col("_seen").isNull()).select(*df.columns, F.lit(1).cast("bigint").alias("_n"))
    several = marked.filter(F.col("_seen").isNotNull()).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    if alone:
        single, several = single.withColumn(ALONE, F.lit(True)), several.withColumn(ALONE, F.lit(False))
    return single.unionByName(several)


def tag_groups(df: DataFrame, spec: CleanSpec, groups: DataFrame | None = None) -> DataFrame:
    """Row groups tagged with the first broken rule's reason and the validity bit."""
    g = groups if groups is not None else row_groups(df)
    known = [ALONE] if ALONE in g.columns else []
    return g.select(*df.columns, "_n", *known, _reason_column(spec).alias("_reason"), _valid_column(spec).alias("_valid"))


EXPAND_CHUNK = 1_000_000  # rows one task emits for one group at most


def _expand(df: DataFrame, start: int, chunk: int | None = None) -> DataFrame:
    """Turn a group with count _n back into (_n - start + 1) rows.

    Groups up to ``chunk`` rows expand in place.  A bigger group (one
    identical row repeated a third of the table) is first cut into chunk
    descriptors - a handful of rows - that are spread over tasks by a
    shuffle, and each task expands one chunk, so no task emits the whole
    group.
    """
    chunk = chunk or EXPAND_CHUNK
    size = F.col("_n") - F.lit(start - 1)
    small = df.filter(size <= chunk).withColumn("_copy", F.explode(F.sequence(F.lit(start), F.col("_n"))))
    big = df.filter(size > chunk).withColumn("_lo", F.explode(F.sequence(F.lit(start), F.col("_n"), F.lit(chunk))))
    # an explicit partition count: AQE must not merge the (tiny) descriptor shuffle back into one task
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    big = big.repartition(parts, "_lo", *[c for c in df.columns if c != "_n"])
    big = big.withColumn("_copy", F.explode(F.sequence(F.col("_lo"), F.least(F.col("_lo") + F.lit(chunk - 1),
                                                                              F.col("_n"))))).drop("_lo")
    return small.unionByName(big).drop("_copy")


def _with_dup_keys(df: DataFrame, exprs: list[str]) -> tuple[DataFrame, list[str]]:
    """Names of the key's columns; an expression that is not a column becomes one (a column is not shuffled twice)."""
    names = [e if e in df.columns else f"_dk{i}" for i, e in enumerate(exprs)]
    return df.select("*", *[F.expr(e).alias(n) for e, n in zip(exprs, names) if n not in df.columns]), names


def _added(names: list[str]) -> list[str]:
    return [n for n in names if n.startswith("_dk")]


def _apart(rows: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Rows known to be alone with their key, which need no shuffle (None if that is not known), and the others."""
    if ALONE not in rows.columns:
        return None, rows
    return rows.filter(F.col(ALONE)).drop(ALONE), rows.filter(~F.col(ALONE)).drop(ALONE)


def _key_counts_flag(rows: DataFrame, spec: CleanSpec) -> DataFrame:
    """duplicate_flag = 1 when more than one distinct row shares the key."""
    alone, rows = _apart(rows)
    rows, names = _with_dup_keys(rows, spec.dup_key)
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_kc"))
    cond = [rows[n].eqNullSafe(counts[n]) for n in names]
    joined = rows.join(counts, cond, "left").select(rows["*"], counts["_kc"])
    flagged = joined.withColumn("duplicate_flag", flag_when(F.col("_kc") > 1)).drop("_kc", *_added(names))
    return flagged if alone is None else alone.withColumn("duplicate_flag", F.lit(0)).unionByName(flagged)


def _first_per_key(rows: DataFrame, spec: CleanSpec, cols: list[str]) -> DataFrame:
    """Mark the first distinct row of each key (_first = true); total order on the other columns.

    Row count per key is a hash aggregation; a key with a single row is its
    own first.  Only keys with several distinct rows go through
    ``min(struct)`` (a sort-based aggregate, partially combined map-side).
    """
    alone, rows = _apart(rows)
    rows, names = _with_dup_keys(rows, spec.dup_key)
    counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_kc"))
    cond = [rows[n].eqNullSafe(counts[n]) for n in names]
    j = rows.join(counts, cond, "left").select(rows["*"], counts["_kc"])
    single = j.filter(F.col("_kc") == 1).withColumn("_first", F.lit(True))
    multi = j.filter(F.col("_kc") > 1)
    firsts = multi.groupBy(*names).agg(F.min(F.struct(*cols)).alias("_min"))
    cond = [multi[n].eqNullSafe(firsts[n]) for n in names]
    marked = multi.join(firsts, cond, "left").select(multi["*"], firsts["_min"]) \
        .withColumn("_first", F.struct(*cols).eqNullSafe(F.col("_min"))).drop("_min")
    out = single.unionByName(marked).drop("_kc", *_added(names))
    return out if alone is None else alone.withColumn("_first", F.lit(True)).unionByName(out)


def clean(df: DataFrame, spec: CleanSpec, mode: str = "flag", groups: DataFrame | None = None) -> CleanResult:
    """``groups`` may be the precomputed (often written) ``row_groups(df)``.  If they were made by the hash of a key
    (``alone``), rows with equal ``spec.dup_key`` must have equal hashes."""
    if mode not in ("flag", "keep_first"):
        raise ValueError(f"unknown mode {mode!r}")
    cols = df.columns
    if mode == "keep_first" and spec.dedup_all_rows:
        return _clean_dedup_first(df, spec, cols, groups)
    g = tag_groups(df, spec, groups)
    reject_cols = [*cols, "reject_reason", "rejected_row_count"]

    rule_rejects = _expand(g.filter(F.col("_reason").isNotNull()), 1).select(
        *cols, F.col("_reason").alias("reject_reason"), F.lit(1).cast("bigint").alias("rejected_row_count")
    )
    valid = g.filter(F.col("_valid"))
    if mode == "flag":
        dup_rejects = valid.filter(F.col("_n") > 1).select(
            *cols,
            F.concat(F.lit("EXACT_DUPLICATE_ROW ("), (F.col("_n") - 1).cast("string"),
                     F.lit(" extra copies removed)")).alias("reject_reason"),
            (F.col("_n") - 1).cast("bigint").alias("rejected_row_count"),
        )
    else:
        dup_rejects = _expand(valid.filter(F.col("_n") > 1), 2).select(
            *cols, F.lit("EXACT_DUPLICATE_ROW").alias("reject_reason"),
            F.lit(1).cast("bigint").alias("rejected_row_count"),
        )
    rejects = rule_rejects.unionByName(dup_rejects)
    known = [ALONE] if ALONE in valid.columns and spec.dup_key else []
    distinct = valid.select(*cols, *known)

    if mode == "keep_first" and spec.dup_key:
        marked = _first_per_key(distinct, spec, cols)
        key_rejects = marked.filter(~F.col("_first")).select(
            *cols, F.lit(spec.dup_reason).alias("reject_reason"),
            F.lit(1).cast("bigint").alias("rejected_row_count"),
        )
        rejects = rejects.unionByName(key_rejects)
        distinct, known = marked.filter(F.col("_first")).select(*cols), []

    cleaned = distinct.select(*cols, *known, *[F.expr(e).alias(n) if isinstance(e, str) else e.alias(n)
                                       for n, e in spec.flags])
    if mode == "flag" and spec.duplicate_flag and spec.dup_key:
        cleaned = _key_counts_flag(cleaned, spec)
    cleaned = standardize(cleaned.drop(ALONE), spec.normalise)
    return CleanResult(cleaned=cleaned, rejects=rejects.select(reject_cols))


def _clean_dedup_first(df: DataFrame, spec: CleanSpec, cols: list[str], groups=None) -> CleanResult:
    """keep_first variant where exact copies are judged over all rows before the rules.

    Surplus copies -> EXACT_DUPLICATE_ROW; the first copy of a group that breaks a
    rule -> that rule's reason; the cleaned table is DISTINCT over the
    normalised valid rows (so rows equal only after normalising collapse).
    """
    g = tag_groups(df, spec, groups)
    dup_rejects = _expand(g.filter(F.col("_n") > 1), 2).select(
        *cols, F.lit("EXACT_DUPLICATE_ROW").alias("reject_reason"),
        F.lit(1).cast("bigint").alias("rejected_row_count"),
    )
    rule_rejects = g.filter(F.col("_reason").isNotNull()).select(
        *cols, F.col("_reason").alias("reject_reason"), F.lit(1).cast("bigint").alias("rejected_row_count")
    )
    valid = g.filter(F.col("_valid")).select(*cols)
    cleaned = standardize(valid, spec.normalise).distinct()
    cleaned = cleaned.select(*cols, *[F.expr(e).alias(n) for n, e in spec.flags])
    return CleanResult(cleaned=cleaned, rejects=dup_rejects.unionByName(rule_rejects))
