"""Personal data by patterns, and terms that disclose it by corpus statistics (operator 3).

Information-theoretic sanitisation: the information of an entity e is -log2 p(e), and a term t tells
log2(p(t, e) / (p(t) p(e))) of it, with p estimated over all documents and p(e | t) at the lower end of its confidence
interval. Terms that tell at least a given part of the entity's information are spans of kind "term" in the documents
that hold the entity. Everything is DataFrame expressions.

Patterns are written so that none is tried again within a run of characters in which it has already failed: a
match starts where a run starts, or where the match before it ended. That gives the leftmost matches of the plain
patterns, in time linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import forget, fresh, table, written

KINDS = ("email", "ip", "card", "phone")
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the kind to occur at all.
HINT = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: Wilson's interval at 95%; terms in more than one of so many texts are counted as frequent.
Z, OFTEN = 1.96, 1000
WORD = r"[\p{L}\p{N}]++"
GENERAL = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|\z)){4}\z")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _running(lengths: Column, level: int = 0) -> Column:
    """The running sums of an array, by doubling: each level adds what stands 2**level before, and there are as many levels as the length asks for."""
    if level == 31:
        return lengths
    step = 1 << level

    def wider(a: Column) -> Column:
        return _running(F.transform(a, lambda x, i: x + F.when(i >= step, F.get(a, i - step)).otherwise(0)), level + 1)

    return F.when(F.size(lengths) > step, _with(lengths, wider)).otherwise(lengths)


def _with(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _cut(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of a pattern's matches, in order, in code points; time in proportion to n log n."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def ended(x: Column) -> Column:
        ends = _running(F.transform(x, lambda p: F.length(p["g"]) + F.length(p["m"])))
        return F.transform(F.arrays_zip(ends.alias("end"), x.alias("x")), lambda p: F.struct((p["end"] - F.length(p["x"]["m"])).alias("start"), p["end"].alias("end"), p["x"]["m"].alias("match")))

    return _with(found, lambda m: _with(F.arrays_zip(m.alias("m"), F.slice(between, 1, F.size(m)).alias("g")), ended))


def _matches(text: Column, kind: str) -> Column:
    """Array of (start, end, match) of the kind, in order."""
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(text.rlike(HINT[kind]), F.filter(_cut(text, PATTERN[kind]), lambda s: _valid(kind, s["match"]))).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Array of (start, rank of the kind, kind, end, match) of a text, sorted."""

    def named(rank: int, kind: str) -> Column:
        return F.transform(_matches(text, kind), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["match"].alias("match")))

    return F.array_sort(F.concat(*[named(i, k) for i, k in enumerate(KINDS)]))


def shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _assured(hits: Column, of: Column) -> Column:
    """The least p at which ``hits`` in ``of`` are no surprise: the lower end of Wilson's interval at Z."""
    share = hits / of
    return (share + Z * Z / (2 * of) - Z * F.sqrt(share * (1 - share) / of + Z * Z / (4 * of * of))) / (1 + Z * Z / of)


def disclosing_terms(held: DataFrame, words: DataFrame, docs: DataFrame, part: float = 0.8) -> DataFrame:
    """(t, term): terms that tell at least ``part`` of the information of an entity of the text of hash t.

    ``held``: (t, kind, value), the entities of texts; ``words``: (t, term), the terms of those texts; ``docs``: (t, text),
    every document. All counts are of distinct texts, so that copies of one text are no evidence, and are exact. What a term
    tells is taken at the lower end of the confidence interval of p(e | t), at any number of texts: the fewer, the less it
    tells. Entities that stand in the same texts have the same terms and are taken together.
    """
    texts = docs.where("text <> ''").dropDuplicates(["t"])
    counts = written(texts.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t")), "terms")
    total = docs.where("text <> ''").select("t").distinct().count()
    entities = held.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_e"), F.bit_xor("t").alias("x"), F.bit_xor(F.xxhash64("t", F.lit(1))).alias("y"))
    entities = entities.where(F.col("n_e") < total)  # what stands everywhere has no information
    classes = written(held.join(entities, ["kind", "value"]).select("t", "n_e", F.xxhash64("n_e", "x", "y").alias("class")).distinct(), "entities")
    met = written(classes.join(words.distinct(), "t").select("class", "n_e", "t", "term"), "met")
    pairs = written(met.groupBy("class", "n_e", "term").agg(F.count(F.lit(1)).alias("n_te")), "pairs")

    # A term's count comes to each of its pairs; the counts of terms in many texts, few, are broadcast.
    often = F.col("n_t") * OFTEN > total
    known = pairs.join(F.broadcast(counts.where(often)), "term", "left")
    rare = known.where("n_t is null").drop("n_t").join(counts.where(~often), "term")
    known = known.where("n_t is not null").select("class", "n_e", "term", "n_te", "n_t").unionByName(rare)
    info = F.log2(F.lit(float(total)) / F.col("n_e"))
    told = F.log2(_assured(F.col("n_te"), F.col("n_t")) * float(total) / F.col("n_e"))
    telling = written(known.where(told >= part * info).select("class", "term"), "telling")
    out = written(met.join(telling, ["class", "term"], "left_semi").select("t", "term").distinct(), "disclosing")
    forget(counts, classes, met, pairs, telling)
    return out


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def personal_data(docs: DataFrame, part: float = 0.8) -> DataFrame:
    """The rows and columns of ``docs`` (doc_id, text and any others) with two arrays of spans.

    base: the e-mail addresses, IPv4 addresses, card and phone numbers, leftmost and non-overlapping for each kind;
    spans: those and the terms that disclose them, sorted by start, then kind. Spans are (start, rank, kind, end,
    match), in code points. Null text counts as empty and has none. Repeated rows are found each; extra columns
    stay, their names given way to. An empty table stays empty.

    Texts are known by a 64-bit hash; entities and words of the texts that have any leave them without the text.
    """
    base, spans, row, more = fresh(docs, "base", "spans", "row", "more")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mark = F.xxhash64(text)
    found = docs.withColumn(base, base_spans(text))
    texts = docs.select(mark.alias("t"), text.alias("text"))
    held = texts.select("t", F.explode(base_spans(F.col("text"))).alias("s")).select("t", F.col("s.kind").alias("kind"), F.lower("s.match").alias("value"))
    held = written(held.distinct(), "held")
    hint = "|".join(f"(?:{h})" for h in HINT.values())
    asked = texts.where(F.col("text").rlike(hint)).join(held.select("t").distinct(), "t", "left_semi").dropDuplicates(["t"])
    places = written(asked.select("t", F.explode(_cut(F.col("text"), WORD)).alias("w")).select("t", F.lower("w.match").alias("term"), F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.col("w.match").alias("match")), "words")
    telling = disclosing_terms(held, places.select("t", "term"), texts, part)
    one = F.struct("start", F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), "end", "match")
    added = places.join(telling, ["t", "term"], "left_semi").groupBy(F.col("t").alias(row)).agg(F.collect_list(one).alias(more))  # at most the words of a text
    out = found.withColumn(row, mark).join(added, row, "left")

    def apart(s):
        return ~F.exists(F.col(base), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    own = F.filter(F.coalesce(more, F.col(base)), lambda s: (s["kind"] == "term") & apart(s))
    return out.withColumn(spans, F.array_sort(F.concat(F.col(base), own))).select(*docs.columns, base, spans)


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced by the name of its kind; of overlapping spans, by the first. Null text stays null, a text without spans as it is."""
    init = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(F.create_map(*[F.lit(x) for kv in GENERAL.items() for x in kv]), s["kind"])).alias("out"))
        return F.when(s["start"] >= acc["at"], new).otherwise(acc)

    return F.aggregate(spans, init, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def op3_pii(spark, sf_dir: str) -> DataFrame:
    """The whole of ``documents``."""
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
