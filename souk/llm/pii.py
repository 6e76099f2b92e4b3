"""Personal data by information-theoretic sanitisation, in built-in functions only.

Protected entities are the base spans: e-mail addresses, IP addresses, card
numbers and phone numbers.  Over the whole corpus, with a line as the context
in which things occur together, a term ``t`` discloses an entity ``c`` to the
degree of their pointwise mutual information
``PMI(c; t) = log2(p(c, t) / (p(c) p(t)))``; the entity itself carries
``IC(c) = -log2 p(c)``.  In lines that hold the entity, a term with
``PMI >= IC / alpha`` is a span of its own: ``removed`` where it gives the entity away
completely (it occurs nowhere else), ``general`` otherwise.  The counts of the entity and of the
term are raised by ``smooth`` in both measures, so the fewer lines support a pair, the larger the
corpus and the rarer the term must be; no number of shared lines is required.  Terms are whole
words of letters and digits of any length.

All counts are plain aggregations, combined before their shuffles.  Lines
without an entity contribute term counts only for terms that were seen with an
entity.  A row gets the disclosing terms of its own lines, never all those of an entity.  The most frequent entity or term is one row per task.

Matching: ``split`` and ``regexp_extract_all`` of one pattern give the text
between matches and the matches, so running sums of their lengths give each match's place in
code points, and those of line ends its line (no span crosses one).  Possessive quantifiers and start conditions
keep the time linear in the text without changing any match.  Entities meet terms line by line: lines that
hold an entity become rows of their own, so a text of very many lines is no single piece of work.

Defined results: a null or empty text has no spans; each row is treated alone, so
repeated rows repeat, and copies count as often as they occur; other
columns pass through, whatever their names: the rows travel as one struct, and an added column
whose name is taken gets underscores before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage

#: Patterns of the base kinds, in the order of the output.
#: A local part is tried once per run of its characters (or where the last match ended).
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a row must contain for a kind to be tried at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: What stands for a removed or generalised span.
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "removed": "", "general": "[TERM]"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_TERM = r"[\p{L}\p{M}\p{N}]++"
SPAN = "array<struct<start:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Settings:
    alpha: float = 1.2  # at 1 only terms that give an entity away completely count
    smooth: float = 1.0  # added to the counts of entities and terms


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _keeps(kind: str):
    return lambda x: _valid(kind, x["value"])


def _as_span(kind: str):
    return lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end"), F.lit(kind).alias("kind"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(numbers: Column, join=lambda a, b: a + b) -> Column:
    """For each element of array<int> the ``join`` of those before it, starting at 0.

    An array that grows by concatenation is copied at each step, so it grows in blocks of 64 and over the blocks."""
    zero = F.array(F.lit(0))
    grow = lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x)))

    def whole(blocks):
        starts = F.slice(F.aggregate(F.transform(blocks, lambda x: F.element_at(x, -1)), zero, grow), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, starts, lambda x, start: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda y: join(y, start))))

    pieces = lambda v: F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / 64).cast("int")), lambda k: F.aggregate(F.slice(v, k * 64 + 1, F.lit(64)), zero, grow))
    return _let(numbers, lambda v: _let(pieces(v), whole))


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, line>> of all matches, places in code points, lines from 0."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ends = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))

    def placed(each):
        starts = _before(F.transform(each, lambda x: F.length(x["gap"]) + F.length(x["value"])))
        lines = _before(F.transform(each, lambda x: ends(x["gap"])))

        def match(x):
            start = x["at"] + F.length(x["e"]["gap"])
            end = start + F.length(x["e"]["value"])
            return F.struct(start.alias("start"), end.alias("end"), x["e"]["value"].alias("value"), (x["line"] + ends(x["e"]["gap"])).alias("line"))

        return F.transform(F.arrays_zip(starts.alias("at"), lines.alias("line"), each.alias("e")), match)

    zipped = _let(found, lambda f: F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(f)), f, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"))))
    return _let(zipped, placed)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a column per kind: array<struct<start, end, value, line>> of its valid matches, by start."""
    t = F.coalesce(F.col(text), F.lit(""))
    for kind, pattern in KINDS.items():
        found = F.filter(_matches(t, pattern), _keeps(kind))
        none = F.array().cast("array<struct<start:int,end:int,value:string,line:int>>")
        hint = t.contains("@") if kind == "email" else t.rlike(HINTS[kind])
        docs = docs.withColumn(f"__{kind}", F.when(hint, found).otherwise(none))
    return docs


def _terms(line: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(_TERM), F.lit(0)), F.lower))


def _hot_lines(marked: DataFrame) -> DataFrame:
    """(row, line, start, content, base, entities, terms) of each line that holds an entity; terms inside a base span are no terms of their own."""
    every = F.concat(*[F.col(f"__{k}") for k in KINDS])
    numbers = F.array_distinct(F.transform(every, lambda x: x["line"]))

    def chosen(lines):
        starts = _before(F.transform(lines, lambda x: F.length(x) + 1))
        return _let(starts, lambda at: F.transform(numbers, lambda k: F.struct(k.alias("line"), F.element_at(at, k + 1).alias("start"), F.element_at(lines, k + 1).alias("content"))))

    lines = marked.select("row", F.explode(_let(F.split("text", "\n", -1), chosen)).alias("l")).select("row", "l.*")
    spans = marked.select("row", F.explode(every).alias("x")).groupBy("row", F.col("x.line").alias("line"))
    hot = lines.join(spans.agg(F.collect_list("x").alias("base"), F.collect_set("x.value").alias("entities")), ["row", "line"])
    return hot.withColumn("terms", F.array_except(_terms(F.col("content")), F.flatten(F.transform("entities", _terms))))


def _pairs(hot: DataFrame) -> DataFrame:
    return hot.select("row", "line", F.explode("entities").alias("entity"), "terms").select("row", "line", "entity", F.explode("terms").alias("term"))


def disclosing_terms(docs: DataFrame, hot: DataFrame, settings: Settings, stage: Stage, text: str = "text") -> DataFrame:
    """(entity, term, removed): terms that disclose an entity.  ``hot``, the written lines with entities,
    give the pairs; all rows of ``docs`` give the counts of terms and lines."""
    pairs = stage.write(_pairs(hot).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")), "together")
    entities = hot.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("of_entity"))
    total = docs.agg(F.sum(F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))).alias("lines"))
    wanted = stage.write(pairs.select("term").distinct(), "wanted")
    # count of the wanted terms over all lines: words of a line once each, combined before the shuffle
    words = docs.select(F.explode(F.split(F.col(text), "\n", -1)).alias("line")).select(F.explode(_terms(F.col("line"))).alias("term"))
    counts = stage.write(words.groupBy("term").agg(F.count(F.lit(1)).alias("of_term")), "terms").join(wanted, "term")
    lines = (total.first()["lines"] or 0) * 1.0
    of_entity, of_term = F.col("of_entity") + settings.smooth, F.col("of_term") + settings.smooth
    ic = -F.log2(of_entity / F.lit(lines))
    pmi = F.log2(F.col("both") * F.lit(lines) / (of_entity * of_term))
    out = pairs.join(entities, "entity").join(counts, "term").filter(pmi >= ic / F.lit(settings.alpha))
    return stage.write(out.select("entity", "term", (F.col("both") == F.col("of_term")).alias("removed")), "disclosing")


def all_spans(marked: DataFrame, hot: DataFrame, terms: DataFrame) -> DataFrame:
    """The marked rows and ``spans`` (array<struct<start, end, kind>>): base spans by kind, then disclosing terms by start."""
    known = _pairs(hot).join(terms, ["entity", "term"]).groupBy("row", "line", "term").agg(F.max("removed").alias("removed"))
    lines = hot.select("row", "line", "start", "content", "base").join(known.select("row", "line").distinct(), ["row", "line"], "left_semi")
    # every word of a line with a disclosing term, as a row: words meet the terms in a join
    words = lines.select("row", "line", "start", "base", F.explode(F.filter(_matches(F.col("content"), _TERM), lambda m: F.col("content").isNotNull())).alias("m"))
    words = words.select("row", "line", F.lower("m.value").alias("term"), (F.col("m.start") + F.col("start")).cast("int").alias("a"), (F.col("m.end") + F.col("start")).cast("int").alias("b"), "base")
    free = words.join(known, ["row", "line", "term"]).filter(~F.exists("base", lambda x: (x["start"] < F.col("b")) & (F.col("a") < x["end"])))
    kind = F.when(F.col("removed"), F.lit("removed")).otherwise(F.lit("general"))
    extra = free.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("a").alias("start"), F.col("b").alias("end"), kind.alias("kind")))).alias("extra"))
    base = F.concat(*[F.transform(f"__{k}", _as_span(k)) for k in KINDS])
    spans = F.concat(base, F.coalesce(F.col("extra"), F.array().cast(SPAN)))
    return marked.join(extra, "row", "left").withColumn("spans", spans).drop("extra", "row")


def _found(docs: DataFrame, settings: Settings, stage: Stage | None, text: str = "text") -> DataFrame:
    """(doc, text, a column per base kind, spans): ``doc`` is the whole row of ``docs``."""
    stage = stage or Stage(docs.sparkSession, "pii")
    found = base_spans(docs.select(F.struct("*").alias("doc"), F.col(text).alias("text")))
    some = F.greatest(*[F.size(f"__{k}") for k in KINDS]) > 0
    # rows with base spans are written with an identity of their own, so a repeated document stays a row
    marked = stage.write(found.filter(some).withColumn("row", F.expr("uuid()")), "marked")
    hot = stage.write(_hot_lines(marked), "hot-lines")
    terms = disclosing_terms(docs, hot, settings, stage, text)
    return all_spans(marked, hot, terms).unionByName(found.filter(~some).withColumn("spans", F.array().cast(SPAN)))


def find_personal_data(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None, text: str = "text") -> DataFrame:
    """``docs`` with a column per base kind (``__email`` and so on) and ``spans``; taken names get underscores before them."""
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        return free("_" + name) if name in taken else name

    found = _found(docs, settings, stage, text)
    return found.select("doc.*", *[F.col(f"__{k}").alias(free(f"__{k}")) for k in KINDS], F.col("spans").alias(free("spans")))


def _digest_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data_spans(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans as text."""
    found = _found(docs.select("doc_id", "text"), settings, None)
    counts = [F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS))
    return found.select("doc.doc_id", *counts, F.sha2(_digest_text(base), 256).alias("base_sha256"), _digest_text(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, settings: Settings = Settings(), stage: Stage | None = None, text: str = "text") -> DataFrame:
    """``docs`` with every span's text replaced by its mark; overlapping spans are replaced as one, by the first one's mark."""
    found = _found(docs, settings, stage, text)
    mark = lambda kind: F.element_at(F.create_map(*[F.lit(x) for kv in MARKS.items() for x in kv]), kind)
    piece = lambda at, x: F.when(x["start"] >= at, F.array(F.substring(F.col("text"), at + 1, x["start"] - at), mark(x["kind"]))).otherwise(F.array().cast("array<string>"))

    def cut(ordered):
        pieces = F.zip_with(_before(F.transform(ordered, lambda x: x["end"]), F.greatest), ordered, piece)
        return F.concat(F.array_join(F.flatten(pieces), ""), F.substring(F.col("text"), F.array_max(F.transform(ordered, lambda x: x["end"])) + 1, F.length("text")))

    cleaned = F.when(F.size("spans") == 0, F.col("text")).otherwise(_let(F.sort_array("spans"), cut))
    return found.select(F.col("doc").withField(f"`{text}`", cleaned).alias("doc")).select("doc.*")
