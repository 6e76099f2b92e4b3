"""Quality rules: a learned decision list over document statistics, in built-in functions only.

Statistics of every document are made once and written.  On the labelled ones,
sequential covering learns an ordered list of rules that reject: a
rule grows as a conjunction of thresholds, each chosen by its information gain over
counts per feature and threshold, is pruned on rows kept apart from growing, and
is taken if it stays precise there; the rows that it covers leave before the next
rule.  Each step is one aggregation whose result has a row per feature and threshold.
The list becomes nested Spark conditional expressions; a document that no rule rejects is kept.

Defined results: a null or empty text has no words and fails the base rule;
labels that are null or whose documents are missing teach nothing; several
labels of a document count as their smallest; without both classes no rule is learnt;
repeated rows are judged one by one; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, Stage

FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "bar_share", "distinct_share")


@dataclass(frozen=True)
class Settings:
    cuts: int = 24  # thresholds of a feature, at quantiles of the labelled rows
    max_rules: int = 6
    max_literals: int = 3
    min_precision: float = 0.9  # on the pruning rows
    min_covered: int = 4  # rejected rows on either part
    seed: int = 9


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the counts of the base rules and the features of the learned ones."""
    t = F.coalesce(F.col(text), F.lit(""))
    gone = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    d = docs.select("doc_id", t.alias("__t"))
    t = F.col("__t")
    blank = " \t\n\x0b\x0c\r"
    words = F.array_remove(F.split(t, WORD_GAP, -1), "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, blank, "")) > 0)
    d = d.select(
        "doc_id",
        words.alias("__w"),
        (F.length(t) - gone(blank)).cast("long").alias("word_chars"),
        gone("#*$%&|<>").cast("long").alias("n_symbols"),
        gone("|").alias("__bars"),
        gone("0123456789").alias("__digits"),
        gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("__upper"),
        lines.alias("__l"),
    )
    # three-word windows as hashes; only texts with a repeated one are sorted
    last = F.size("__w") - 2
    windows = F.when(last > 1, F.transform(F.slice("__w", F.lit(1), F.greatest(last, F.lit(1))), lambda w, i: F.xxhash64(w, F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("__h", windows)
    repeated = F.size(F.array_distinct("__h")) < F.size("__h")
    order = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("__s", F.when(repeated, order).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    twice = F.filter("__s", lambda x, k: (F.get("__s", k - 1)["h"] == x["h"]) | (F.get("__s", k + 1)["h"] == x["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    d = d.withColumns({
        "n_words": F.size("__w").cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "n_repeat_words": F.when(F.size("__s") > 0, covered).otherwise(F.lit(0)).cast("long"),
        "__lines": F.size("__l"),
        "__kinds": F.size(F.array_distinct("__w")),
    })
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "__lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("__upper", "word_chars").alias("upper_share"),
        share("__digits", "word_chars").alias("digit_share"),
        share("__bars", "n_words").alias("bar_share"),
        share("__kinds", "n_words").alias("distinct_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def _all(literals: list[Literal]) -> Column:
    out = F.lit(True)
    for x in literals:
        out = out & x.column()
    return out


def _counts(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """(feature, number of thresholds below the value) -> (rejected, kept) rows; a bounded result."""
    at = lambda f: sum((F.col(f) > t).cast("int") for t in thresholds[f]) if thresholds[f] else F.lit(0)
    bins = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), at(f).alias("b")) for f in FEATURES])).alias("x")
    got = rows.select("bad", bins).groupBy("x.f", "x.b").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
    return {(r["f"], r["b"]): (r["bad"], r["n"] - r["bad"]) for r in got}


def _best_literal(counts: dict, thresholds: dict[str, list[float]], s: Settings) -> tuple[Literal, int, int] | None:
    """The literal with the largest information gain, with the rejected and kept rows that it covers."""
    bad, good = (sum(v[k] for (f, _), v in counts.items() if f == FEATURES[0]) for k in (0, 1))
    if not bad:
        return None
    before, best = log2(bad / (bad + good)), None
    for f in FEATURES:
        for k, t in enumerate(thresholds[f]):
            for above in (True, False):
                side = [v for (g, b), v in counts.items() if g == f and (b > k) == above]
                p, n = sum(v[0] for v in side), sum(v[1] for v in side)
                if p >= s.min_covered:
                    gain = p * (log2(p / (p + n)) - before)
                    if gain > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, Literal(f, above, t), p, n)
    return best and best[1:]


def _centred(x: Literal, rows: DataFrame) -> Literal:
    """The literal with its threshold halfway between the nearest values on its two sides."""
    v = F.col(x.feature).cast("double")
    near = rows.agg(F.max(F.when(v <= x.threshold, v)).alias("a"), F.min(F.when(v > x.threshold, v)).alias("b")).first()
    return x if near["a"] is None or near["b"] is None else Literal(x.feature, x.above, (near["a"] + near["b"]) / 2)


def learn(stats: DataFrame, labels: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> list[list[Literal]]:
    """The ordered rules that reject, from ``labels`` (doc_id, quality)."""
    s, stage = settings, stage or Stage(stats.sparkSession, "rules")
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 0).cast("int").alias("bad"))
    rows = stats.filter(~base_failed()).select("doc_id", *FEATURES).join(known, "doc_id")
    rows = stage.write(rows.select("bad", (F.pmod(F.xxhash64("doc_id", F.lit(s.seed)), F.lit(3)) < 2).alias("growing"), *FEATURES), "labelled")
    grid = [(k + 1) / (s.cuts + 1) for k in range(s.cuts)]
    quantiles = lambda f: F.percentile_approx(F.col(f).cast("double"), grid, 2000)
    each = [rows.filter(cond).agg(*[quantiles(f).alias(f) for f in FEATURES]).first() for cond in ("true", "bad = 1")]
    thresholds = {f: sorted({t for r in each for t in (r[f] or [])}) for f in FEATURES}
    rules: list[list[Literal]] = []
    while len(rules) < s.max_rules:
        left = rows.filter(~_any(rules))
        rule: list[Literal] = []
        while len(rule) < s.max_literals:
            found = _best_literal(_counts(left.filter(F.col("growing") & _all(rule)), thresholds), thresholds, s)
            if not found:
                break
            rule.append(_centred(found[0], left.filter(F.col("growing") & _all(rule))))
            if found[2] <= 0.02 * found[1]:
                break
        if not rule:
            break
        # prune: the shortest beginning that is as good on the other rows as any
        held = left.filter("not growing").agg(*[x for k in range(len(rule)) for x in (F.sum(F.when(_all(rule[: k + 1]), F.col("bad"))).alias(f"p{k}"), F.sum(_all(rule[: k + 1]).cast("int")).alias(f"n{k}"))]).first()
        precise = [((held[f"p{k}"] or 0) / (held[f"n{k}"] or 1), held[f"p{k}"] or 0) for k in range(len(rule))]
        best = max(range(len(rule)), key=lambda k: (2 * precise[k][0] - 1, precise[k][1], -k))
        if precise[best][0] < s.min_precision or precise[best][1] < s.min_covered:
            break
        rules.append(rule[: best + 1])
    return rules


def _any(rules: list[list[Literal]]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all(rule)
    return out


def verdict(rules: list[list[Literal]]) -> Column:
    """Number of the first rule (from 1) that rejects, 0 if none does: an ordered conditional expression."""
    out = F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all(rule), F.lit(k)).otherwise(out)
    return out


def quality_verdicts(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), stage: Stage | None = None) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the number of the rule that rejects (0: none)."""
    stage = stage or Stage(docs.sparkSession, "quality")
    stats = stage.write(statistics(docs), "statistics")
    rule = verdict(learn(stats, labels, settings, stage))
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", rule.cast("int"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
